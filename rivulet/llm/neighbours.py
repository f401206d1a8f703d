"""Op 5: nearest neighbours by few stable projections, a kd-tree over them, and a chi-square stopping test.

Inner products become distances: with M the largest norm, a vector x gets one more component sqrt(M^2 - |x|^2) and a
query q is scaled to norm M with 0 there, so the nearest point has the largest product. ``dims`` Gaussian
(2-stable) projections shrink a distance d to one whose square is d^2 times a chi-square variable with ``dims``
degrees of freedom. A kd-tree over the projected points yields leaves in order of projected distance; their points
are verified by exact products until, with r the projected distance of the next leaf and d the k-th best distance
found, the chi-square distribution at r^2 / d^2 reaches ``confidence``: a nearer point would have shown by then.

Plan. Vectors fall into blocks by a hash of the id and queries into chunks; every (block, chunk) pair is one bounded
task: block-nested search of a stated query set. Each returns k candidates a query, and the best k of all blocks
stay. Equal vectors of a block are searched once and carry their least ids.

Defined results. Null and zero vectors and those with null or non-finite components take no part; vectors of another
length are searched among themselves. Ties go to the smaller id, also where they are cut: of equal scores the groups of
equal vectors with the least ids stay. Null ids take no part. Rows that share an id are rows of their own, as candidates
and as queries, in the order of a hash of their vectors; a row leaves out itself alone. An empty table gives an empty
result. Other columns, whatever their names, are not carried.
"""

from __future__ import annotations

from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import table, tidy

LEAF = 64


def chi_square_cdf(x: np.ndarray, dims: int) -> np.ndarray:
    """For even ``dims``."""
    h = np.minimum(x / 2, 700.0)
    return 1 - np.exp(-h) * sum(h**j / factorial(j) for j in range(dims // 2))


def leaves(points: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    """Point numbers by kd-tree leaf: the widest side is split at its median."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        at = todo.pop()
        if len(at) <= size:
            out.append(at)
            continue
        p = points[at]
        side = p[:, np.argmax(p.max(axis=0) - p.min(axis=0))]
        order = np.argpartition(side, len(at) // 2)
        todo += [at[order[: len(at) // 2]], at[order[len(at) // 2 :]]]
    return out


def search(x: np.ndarray, ids: np.ndarray, nths: np.ndarray, copies: np.ndarray, q: np.ndarray, q_ids: np.ndarray, q_nths: np.ndarray, k: int, top: float, dims: int = 8, confidence: float = 0.95, seed: int = 3):
    """(query number, row number, score) of each query's k best in one block, itself left out once. ``top``: the largest norm.

    A row is told by ``ids`` and ``nths``, and stands for ``copies`` equal rows.
    """
    rows = np.ascontiguousarray(x).view([("", x.dtype)] * x.shape[1]).ravel()
    _, first, group = np.unique(rows, return_index=True, return_inverse=True)
    by_id = np.lexsort((nths, ids))
    rank = np.empty(len(ids), np.int64)
    rank[by_id] = np.arange(len(ids))
    order = np.lexsort((rank, group))
    starts = np.searchsorted(group[order], np.arange(len(first)))
    stops = np.append(starts[1:], len(order))
    least = np.append(rank[order[starts]], len(ids))  # of each group; the last for none
    pts = x[first].astype(np.float64)
    n, d = pts.shape
    lift = np.sqrt(np.maximum(top**2 - (pts**2).sum(axis=1), 0))
    g = np.random.default_rng(seed).normal(size=(d + 1, dims))
    proj = pts @ g[:d] + lift[:, None] * g[d]
    scale = top / np.sqrt((q**2).sum(axis=1))
    q_proj = (q * scale[:, None]) @ g[:d]
    parts = leaves(proj)
    low = np.array([proj[p].min(axis=0) for p in parts])
    high = np.array([proj[p].max(axis=0) for p in parts])
    dist = np.zeros((len(q), len(parts)))
    for j in range(dims):
        off = np.maximum(np.maximum(low[:, j] - q_proj[:, j, None], q_proj[:, j, None] - high[:, j]), 0)
        dist += off**2
    visit = np.argsort(dist, axis=1, kind="stable")
    near = np.take_along_axis(dist, visit, axis=1)
    keep = k + 1  # one may be the query itself
    best = np.full((len(q), keep), -np.inf)
    who = np.full((len(q), keep), -1, np.int64)
    live = np.arange(len(q))
    for r in range(len(parts)):
        leaf = visit[live, r]
        by = np.argsort(leaf, kind="stable")
        cuts = np.flatnonzero(np.r_[True, leaf[by][1:] != leaf[by][:-1]])
        for s, e in zip(cuts, np.append(cuts[1:], len(by))):
            some, p = live[by[s:e]], parts[leaf[by[s]]]
            score = np.concatenate([best[some], q[some] @ pts[p].T], axis=1)
            name = np.concatenate([who[some], np.broadcast_to(p, (len(some), len(p)))], axis=1)
            cut = np.argsort(least[name], axis=1)
            score, name = np.take_along_axis(score, cut, 1), np.take_along_axis(name, cut, 1)
            cut = np.argsort(-score, axis=1, kind="stable")[:, :keep]
            best[some], who[some] = np.take_along_axis(score, cut, 1), np.take_along_axis(name, cut, 1)
        if r + 1 == len(parts):
            break
        worst = best[live].min(axis=1)
        reach = 2 * top**2 - 2 * worst * scale[live]  # squared distance of the k-th best
        with np.errstate(divide="ignore", invalid="ignore"):
            done = np.isfinite(worst) & (chi_square_cdf(near[live, r + 1] / np.maximum(reach, 1e-12), dims) >= confidence)
        live = live[~done]
        if not len(live):
            break
    out_q, out_row, out_s = [], [], []
    for i in range(len(q)):
        own = who[i][who[i] >= 0]
        # one fixed order of summation, so equal vectors have equal scores
        score = (pts[own] * q[i]).sum(axis=1)
        names, scores = [], []
        for v, sc in zip(own, score):
            at = order[starts[v] : stops[v]][: k + 1]
            times = np.minimum(copies[at] - ((ids[at] == q_ids[i]) & (nths[at] == q_nths[i])), k)
            at = np.repeat(at, times)
            names.append(at)
            scores.append(np.full(len(at), sc))
        names, scores = np.concatenate(names), np.concatenate(scores)
        pick = np.lexsort((rank[names], -scores))[:k]
        out_q.append(np.full(len(pick), i))
        out_row.append(names[pick])
        out_s.append(scores[pick])
    return np.concatenate(out_q), np.concatenate(out_row), np.concatenate(out_s)


def nearest(
    vectors: DataFrame, is_query: Column, *, key: str = "vec_id", vector: str = "embedding", k: int = 20, block_rows: int = 8192, chunk_rows: int = 8192, dims: int = 8, confidence: float = 0.95
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of largest inner product for each row where ``is_query``."""
    tidy(vectors.sparkSession)
    v = F.col(vector)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.filter(F.col(key).isNotNull() & v.isNotNull() & good).select(
        F.col(key).cast("long").alias("id"), v.cast("array<double>").alias("v"), F.size(v).alias("d"), F.coalesce(is_query, F.lit(False)).alias("q")
    )
    if rows.groupBy("id").count().filter("count > 1").limit(1).count():
        rows = rows.groupBy("id", "v", "d", "q").agg(F.count(F.lit(1)).alias("copies")).withColumn("nth", F.xxhash64("v"))
    else:
        rows = rows.withColumns({"copies": F.lit(1).cast("long"), "nth": F.lit(0).cast("long")})
    stats = rows.agg(F.count(F.lit(1)), F.sum(F.col("q").cast("long")), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()
    blocks, chunks = max(1, -(-stats[0] // block_rows)), max(1, -(-(stats[1] or 0) // chunk_rows))
    top = float(stats[2] or 1.0) ** 0.5
    base = rows.withColumn("block", F.pmod(F.xxhash64("id", "nth"), F.lit(blocks)).cast("int"))
    data = base.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    ask = base.filter("q").withColumn("chunk", F.pmod(F.xxhash64(F.lit(5), F.col("id"), F.col("nth")), F.lit(chunks)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def pair(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        col = lambda t, c: t[c].to_numpy(np.int64)
        if not len(left) or not len(right):
            return pd.DataFrame({c: pd.Series(dtype="float64" if c == "score" else "int64") for c in ("query_id", "query_nth", "times", "vec_id", "nth", "score")})
        who = (col(left, "id"), col(left, "nth"), col(left, "copies"))
        ask = (col(right, "id"), col(right, "nth"))
        q, r, s = search(np.stack(left["v"].to_numpy()), *who, np.stack(right["v"].to_numpy()), *ask, k, top, dims, confidence)
        return pd.DataFrame({"query_id": ask[0][q], "query_nth": ask[1][q], "times": col(right, "copies")[q], "vec_id": who[0][r], "nth": who[1][r], "score": s})

    on, some = ["d", "block", "chunk"], ["id", "nth", "copies", "v"]
    found = data.select(*some, *on).groupBy(*on).cogroup(ask.select(*some, *on).groupBy(*on)).applyInPandas(pair, "query_id long, query_nth long, times long, vec_id long, nth long, score double")
    best = Window.partitionBy("query_id", "query_nth").orderBy(F.desc("score"), "vec_id", "nth")
    kept = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return kept.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("query_id", "rank", "vec_id", "score")


def op5_nearest(spark, sf_dir: str) -> DataFrame:
    """Query: the 20 nearest of every 20th embedding."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
