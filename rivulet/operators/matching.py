"""Fingerprint matching: scores, status by thresholds, best templates, pair matrix and star clusters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions import bits
from rivulet.operators.graph import written

#: The acceptance score, the margin over the next template, and the near tie for an upright page.
ACCEPT, MARGIN, NEAR_TIE = 0.90, 0.03, 0.01
#: Grids of a block: a group of the shuffle holds one block of each side, whatever the number of grids of a band.
PAGES, SAMPLES, ITEMS = 2048, 65536, 2048
#: Grids of a block where a group gives one row a grid, not its pairs; and of a tile of the pairs that are looked at together.
STARS, TILE = 16384, (32, 8192)


def _packed(df: DataFrame, n: int, rows: int, prefix: str) -> tuple[DataFrame, list[str], list[str]]:
    """The grid and its dilation as 32-bit word columns, computed once a row."""
    wide = df.withColumn("__wide", bits.dilate(F.col("grid"), n))
    a, b = bits.words(F.col("grid"), n, rows), bits.words(F.col("__wide"), n, rows)
    names, wides = [f"{prefix}w{i}" for i in range(len(a))], [f"{prefix}d{i}" for i in range(len(b))]
    keep = [F.col(c).alias(f"{prefix}{c}") for c in df.columns if c != "grid"]
    return wide.select(*keep, *[c.alias(x) for c, x in zip(a + b, names + wides)]), names, wides


def scored(pages: DataFrame, samples: DataFrame, n: int = 8, rows: int = 8, exclude_self: bool = True) -> DataFrame:
    """``id, template, rotate, search, score``: each page's grid against all samples of its search band.

    Samples are a dimension table; the join is on the search band and the score is plain column arithmetic.
    """
    p, pw, pd_ = _packed(pages, n, rows, "p_")
    s, sw, sd = _packed(samples, n, rows, "s_")
    on = F.col("p_search") == F.col("s_search")
    if exclude_self:
        on = on & (F.col("p_id") != F.col("s_id"))
    cols = lambda names: [F.col(c) for c in names]
    return p.join(s, on).select(
        F.col("p_id").alias("id"), F.col("s_template").alias("template"), F.col("s_rotate").alias("rotate"), F.col("s_search").alias("search"),
        bits.coverage(cols(pw), cols(pd_), cols(sw), cols(sd)).alias("score"),
    )


def _dealt(df: DataFrame, keys: list[str], id_: str, size: int, out: str) -> DataFrame:
    """``df`` in blocks of about ``size`` rows of one key: its ``out`` and the number of blocks of the key, ``out``_n."""
    n = df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(f"{out}_n"))
    return df.join(n, keys).withColumn(out, F.pmod(F.xxhash64(id_), F.col(f"{out}_n")).cast("int"))


def _met(df: DataFrame, keys: list[str], id_: str, size: int) -> DataFrame:
    """Each pair of blocks of a key as a group ``i, j``: rows of the lesser ``block`` meet those of the greater one, or one another."""
    x = _dealt(df, keys, id_, size, "block")
    other = F.explode(F.sequence(F.lit(0), F.col("block_n") - 1))
    return x.withColumn("with", other).withColumns({"i": F.least("block", "with"), "j": F.greatest("block", "with")}).drop("with", "block_n")


def _tasks(df: DataFrame) -> int:
    """Partitions that stay apart: blocks are few bytes and much work, and would be put together by their bytes."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _bits(t: pa.Table, names: list[str]) -> np.ndarray:
    """32-bit word columns as 64-bit words: one row a grid."""
    w = [t[c].to_numpy().astype(np.uint64) for c in names]
    w = w if len(w) % 2 == 0 else [*w, np.zeros(t.num_rows, np.uint64)]
    return np.stack([a | (b << np.uint64(32)) for a, b in zip(w[::2], w[1::2])], axis=1)


def _coverage(a: np.ndarray, aw: np.ndarray, b: np.ndarray, bw: np.ndarray) -> np.ndarray:
    """``bits.coverage`` of every grid of one side with every grid of the other, in the same arithmetic."""
    def both(x, y):
        out = np.bitwise_count(x[:, None, 0] & y[None, :, 0]).astype(np.int32)
        for k in range(1, x.shape[1]):
            out += np.bitwise_count(x[:, None, k] & y[None, :, k])
        return out

    na, nb = (np.maximum(1, np.bitwise_count(x).sum(axis=1, dtype=np.int64)) for x in (a, b))
    return np.minimum(both(a, bw) / na[:, None], both(aw, b) / nb[None, :])


def best_scores(pages: DataFrame, samples: DataFrame, n: int = 8, rows: int = 8, exclude_self: bool = True) -> DataFrame:
    """``scored``'s greatest score of each ``id, template, rotate, search``; grids, bands and ids that are null match nothing.

    All pairs of a band are compared, so the work grows with the product of both sides. Blocks of pages meet blocks of
    samples in a cogroup each, so that one band is many tasks of bounded memory, and pairs do not leave the task: it gives
    one row for each page and kind of sample.
    """
    whole = lambda df: df.filter(F.col("grid").isNotNull() & F.col("search").isNotNull() & F.col("id").isNotNull())
    p, pw, pd_ = _packed(whole(pages).select("id", "search", "grid"), n, rows, "p_")
    s, sw, sd = _packed(whole(samples).select("id", "template", "rotate", "search", "grid"), n, rows, "s_")
    p = _dealt(p.withColumnRenamed("p_search", "band"), ["band"], "p_id", PAGES, "pb")
    s = _dealt(s.withColumn("band", F.col("s_search")), ["band"], "s_id", SAMPLES, "sb")
    blocks = p.select("band", "pb_n").distinct().join(s.select("band", "sb_n").distinct(), "band")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    p = p.drop("pb_n").join(blocks.select("band", "sb_n"), "band").withColumn("sb", every("sb_n")).drop("sb_n")
    s = s.drop("sb_n").join(blocks.select("band", "pb_n"), "band").withColumn("pb", every("pb_n")).drop("pb_n")
    kinds = {f.name: f.dataType for f in s.schema} | {f.name: f.dataType for f in p.schema}
    schema = T.StructType([T.StructField(c, kinds[k]) for c, k in (("id", "p_id"), ("template", "s_template"), ("rotate", "s_rotate"), ("search", "s_search"))] + [T.StructField("score", T.DoubleType())])

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({"id": a["p_id"][:0], "template": b["s_template"][:0], "rotate": b["s_rotate"][:0], "search": b["s_search"][:0], "score": pa.array([], pa.float64())})
        code = np.zeros(b.num_rows, np.int64)
        for c in ("s_template", "s_rotate", "s_search"):
            codes = pa.chunked_array([b[c].combine_chunks()]).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            code = code * (codes.max() + 1) + codes
        b = b.take(pa.array(np.argsort(code, kind="stable")))
        code = np.sort(code, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        x, xd, y, yd = _bits(a, pw), _bits(a, pd_), _bits(b, sw), _bits(b, sd)
        aid, bid = a["p_id"].to_numpy(), b["s_id"].to_numpy()
        by_id = np.argsort(bid, kind="stable")
        lo, hi = np.searchsorted(bid[by_id], aid, "left"), np.searchsorted(bid[by_id], aid, "right")
        step, best = max(1, (1 << 19) // len(bid)), []
        for i in range(0, len(aid), step):
            sc = _coverage(x[i : i + step], xd[i : i + step], y, yd)
            for k in range(len(sc) if exclude_self else 0):
                sc[k, by_id[lo[i + k] : hi[i + k]]] = -1.0
            best.append(np.maximum.reduceat(sc, first, axis=1))
        top = np.concatenate(best)
        page, kind = np.nonzero(top >= 0)
        of = b.take(pa.array(first[kind]))
        return pa.table({"id": a["p_id"].take(pa.array(page)), "template": of["s_template"], "rotate": of["s_rotate"], "search": of["s_search"], "score": top[page, kind]})

    tasks, of = _tasks(pages), ["band", "pb", "sb"]
    met = p.repartition(tasks, *of).groupBy(*of).cogroup(s.repartition(tasks, *of).groupBy(*of)).applyInArrow(run, schema)
    return met.groupBy("id", "template", "rotate", "search").agg(F.max("score").alias("score"))


def best_of_template(scores: DataFrame) -> DataFrame:
    """``id, template, rotate, search, score, top``: each template's pick.

    The pick is the greatest (score, rotate, template, search), or the best upright one scoring within 0.01 of it.
    ``top`` is the score of the greatest itself. Aggregates combine before the shuffle.
    """
    row = F.struct("score", "rotate", "template", "search")
    best = scores.groupBy("id", "template").agg(F.max(row).alias("b"), F.max(F.when(F.col("rotate") == 0, row)).alias("u"))
    pick = F.when(F.col("u").isNotNull() & (F.col("b.score") - F.col("u.score") < NEAR_TIE), F.col("u")).otherwise(F.col("b"))
    return best.select("id", pick.alias("p"), F.col("b").alias("b")).select("id", "p.template", "p.rotate", "p.search", "p.score", F.col("b").alias("top"))


def match_status(pages: DataFrame, samples: DataFrame, **options) -> DataFrame:
    """One row per page: ``id, status, template, rotate, search, score, runner_up, runner_up_score``.

    OK with 0.90 or more and 0.03 over the best other template; AMBIGUOUS with 0.90 or more; else UNKNOWN_FRAME;
    NO_FRAME without any sample of the band.
    """
    per = best_of_template(best_scores(pages, samples, **options))
    w = Window.partitionBy("id").orderBy(F.desc("top"))
    ranked = per.withColumns({"r": F.row_number().over(w), "ru": F.lead("top").over(w)}).filter("r = 1")
    margin = F.col("score") - F.coalesce(F.col("ru.score"), F.lit(0.0))
    status = F.when(F.col("score").isNull(), "NO_FRAME").when((F.col("score") >= ACCEPT) & (margin >= MARGIN), "OK").when(F.col("score") >= ACCEPT, "AMBIGUOUS").otherwise("UNKNOWN_FRAME")
    return pages.select("id").join(ranked, "id", "left").select(
        "id", status.alias("status"), "template", "rotate", "search", "score", F.col("ru.template").alias("runner_up"), F.coalesce("ru.score", F.lit(0.0)).alias("runner_up_score")
    )


def top_templates(pages: DataFrame, samples: DataFrame, n: int = 3, **options) -> DataFrame:
    """The first n distinct templates of each page, each at its own pick: ``id, rank, template, rotate, search, score``."""
    w = Window.partitionBy("id").orderBy(F.desc("top"))
    per = best_of_template(best_scores(pages, samples, **options)).withColumn("rank", F.row_number().over(w))
    return per.filter(F.col("rank") <= n).select("id", "rank", "template", "rotate", "search", "score")


def pair_similarity(items: DataFrame, least: float = 0.0, n: int = 8, rows: int = 8, group: str | None = None) -> DataFrame:
    """``a, b, sim`` (a < b) of items of the same search band (and ``group``), the greater of both directions."""
    keys = ["search", group] if group else ["search"]
    whole = [F.col(c).isNotNull() for c in ("grid", "id", *keys)]
    cond: Column = whole[0]
    for c in whole[1:]:
        cond = cond & c
    x, xw, xd = _packed(items.filter(cond).select("id", "grid", *keys), n, rows, "a_")
    x = _met(x, [f"a_{k}" for k in keys], "a_id", ITEMS)
    kind = x.schema["a_id"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("sim", T.DoubleType())])

    def run(t: pa.Table) -> pa.Table:
        at = t["block"].to_numpy()
        w, wide, ids = _bits(t, xw), _bits(t, xd), t["a_id"].to_numpy()
        one = t["i"][0].as_py() == t["j"][0].as_py()
        left = np.arange(len(at)) if one else np.flatnonzero(at == t["i"][0].as_py())
        right = left if one else np.flatnonzero(at == t["j"][0].as_py())
        found, step = [], max(1, (1 << 19) // max(1, len(right)))
        for k in range(0, len(left) if len(right) else 0, step):
            rows_ = left[k : k + step]
            sim = _coverage(w[rows_], wide[rows_], w[right], wide[right])
            a, b = np.nonzero(sim >= least)
            v, a, b = sim[a, b], ids[rows_[a]], ids[right[b]]
            keep = a < b if one else a != b
            found.append((np.minimum(a, b)[keep], np.maximum(a, b)[keep], v[keep]))
        cols = [np.concatenate(c) for c in zip(*found)] if found else [ids[:0], ids[:0], np.zeros(0)]
        return pa.table(dict(zip(("a", "b", "sim"), cols)))

    of = [*[f"a_{k}" for k in keys], "i", "j"]
    return x.repartition(_tasks(items), *of).groupBy(*of).applyInArrow(run, schema)


def star_clusters(items: DataFrame, sims: DataFrame, threshold: float) -> DataFrame:
    """``group_no, representative, id`` of ``items`` (``id, weight``) with similarities ``sims`` (``a, b, sim``; all pairs, each once).

    The free item with most free neighbours (``sim`` of ``threshold`` or more) takes them all, until none is left; ties go
    to the weight, then to the lesser id. Groups are numbered by size, then in the order they are taken. The
    representative has the greatest mean similarity in its group (to four places), with the same ties.

    A round takes every item that stands first among all within two steps of it. Two such items are three steps apart
    at least, so neither changes the other's neighbours and the groups are those of one choice after another.
    """
    both = sims.select("a", "b", "sim").unionByName(sims.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"))
    edges = written(both.filter(F.col("sim") >= threshold).select("a", "b"))
    free, taken = written(items.select("id", F.coalesce("weight", F.lit(0.0)).alias("weight"))), None
    while free.limit(1).count():
        inner = edges.join(free.select(F.col("id").alias("a")), "a", "left_semi").join(free.select(F.col("id").alias("b")), "b", "left_semi")
        degree = free.join(inner.groupBy(F.col("a").alias("id")).agg(F.count(F.lit(1)).alias("n")), "id", "left").fillna(0, ["n"])
        first = written(degree.select("id", F.struct("n", "weight", (-F.col("id")).alias("o")).alias("p")))
        edges = written(inner)
        around = lambda t: t.join(edges.join(t.select(F.col("id").alias("b"), F.col("p").alias("q")), "b").groupBy(F.col("a").alias("id")).agg(F.max("q").alias("q")), "id", "left").select("id", F.greatest("p", F.coalesce("q", "p")).alias("p"))  # noqa: E731, B023
        leads = around(around(first)).withColumnRenamed("p", "best").join(first, "id").filter("p = best")
        leads = written(leads.select(F.col("id").alias("lead"), "p"))
        groups = leads.join(edges.withColumnRenamed("a", "lead"), "lead").select("lead", "p", F.col("b").alias("id")).unionByName(leads.select("lead", "p", F.col("lead").alias("id")))
        groups = written(groups)
        taken = groups if taken is None else taken.unionByName(groups)
        free = written(free.join(groups.select("id"), "id", "left_anti"))
    if taken is None:
        return items.sparkSession.createDataFrame([], "group_no long, representative long, id long")
    of = taken.select("lead", "id")
    within = both.join(of.withColumnsRenamed({"id": "a", "lead": "g"}), "a").join(of.withColumnsRenamed({"id": "b", "lead": "h"}), "b").filter("g = h")
    total = within.groupBy(F.col("a").alias("id")).agg(F.sum("sim").alias("s"))
    mean = F.round((F.coalesce("s", F.lit(0.0)) + 1) / (F.col("p.n") + 1), 4)
    scored_ = taken.join(items.select("id", F.coalesce("weight", F.lit(0.0)).alias("weight")), "id").join(total, "id", "left")
    groups = scored_.groupBy("lead").agg(F.max(F.struct(mean.alias("m"), "weight", (-F.col("id")).alias("o"), "id")).alias("r"), F.max("p").alias("p"))
    numbered = groups.withColumn("group_no", F.row_number().over(Window.orderBy(F.desc("p"))).cast("long"))  # one row a group
    return of.join(numbered.select("lead", "group_no", F.col("r.id").alias("representative")), "lead").select("group_no", "representative", "id")


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that every grid of one side shares with every grid of the other."""
    out = np.bitwise_count(a[:, None, 0] & b[None, :, 0])
    out = out if a.shape[1] < 4 else out.astype(np.uint16)
    for k in range(1, a.shape[1]):
        out += np.bitwise_count(a[:, None, k] & b[None, :, k])
    return out


class _Grids:
    """Grids with what the likeness of a pair needs; ``near`` tells where ``_coverage`` is ``threshold`` or more."""

    def __init__(self, bits_: np.ndarray, wide: np.ndarray, threshold: float):
        size = 64 * bits_.shape[1]
        # the least number of covered bits of n that is enough, in the score's own arithmetic
        least = np.count_nonzero(np.arange(size + 1)[None, :] / np.maximum(1, np.arange(size + 1))[:, None] < threshold, axis=1)
        self.bits, self.wide = bits_, wide
        self.least = least[np.bitwise_count(bits_).sum(axis=1, dtype=np.int64)].astype(np.uint8 if size < 255 else np.uint16)

    def of(self, at) -> _Grids:
        new = object.__new__(_Grids)
        new.bits, new.wide, new.least = self.bits[at], self.wide[at], self.least[at]
        return new

    def near(self, other: _Grids) -> np.ndarray:
        return (_common(self.bits, other.wide) >= self.least[:, None]) & (_common(self.wide, other.bits) >= other.least[None, :])

    def sim(self, other: _Grids) -> np.ndarray:
        return _coverage(self.bits, self.wide, other.bits, other.wide)


def _tiles(n: int, m: int):
    """Slices of n rows and m columns that cover all pairs."""
    for i in range(0, n, TILE[0]):
        for j in range(0, m, TILE[1]):
            yield slice(i, i + TILE[0]), slice(j, j + TILE[1])


def _pair_sums(x: DataFrame, keys: list[str], words: list[str], wides: list[str], threshold: float | None, tasks: int) -> DataFrame:
    """``id, s``: for each grid the sum over all others of its key of the likeness, or of 1 where it is ``threshold`` or more.

    A grid counts ``a_m`` times. Pairs stay in their tasks; a group of two blocks gives one row a grid.
    """
    x = _met(x.select(*keys, "a_id", "a_m", *words, *wides), keys, "a_id", STARS)
    schema = T.StructType([T.StructField("id", x.schema["a_id"].dataType), T.StructField("s", T.DoubleType())])

    def run(t: pa.Table) -> pa.Table:
        at, m = t["block"].to_numpy(), t["a_m"].to_numpy().astype(np.float64)
        g, out = _Grids(_bits(t, words), _bits(t, wides), threshold or 0.0), np.zeros(t.num_rows)
        one = t["i"][0].as_py() == t["j"][0].as_py()
        left = np.flatnonzero(at == t["i"][0].as_py())
        right = left if one else np.flatnonzero(at == t["j"][0].as_py())
        for i, j in _tiles(len(left), len(right)):
            a, b = left[i], right[j]
            v = g.of(a).sim(g.of(b)) if threshold is None else g.of(a).near(g.of(b)).astype(np.float64)
            if one:
                v[a[:, None] == b[None, :]] = 0.0
            else:
                out[b] += m[a] @ v
            out[a] += v @ m[b]
        return pa.table({"id": t["a_id"], "s": out})

    of = [*keys, "i", "j"]
    return x.repartition(tasks, *of).groupBy(*of).applyInArrow(run, schema).groupBy("id").agg(F.sum("s").alias("s"))


def _stars(g: _Grids, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each grid the place of the one that takes it, and the neighbours which that one had: one choice after another.

    ``n`` counts the neighbours of each grid at first, ``m`` how often it is there; of equals the first place is chosen. A
    choice takes its free neighbours out of the counts of those left, so no list of pairs is kept.
    """
    lead, size, at, n, own = np.arange(len(n)), n.copy(), np.arange(len(n)), n.copy(), m
    while len(at):
        k = int(n.argmax())
        if n[k] == 0:
            break
        taken = g.of([k]).near(g)[0]
        taken[k] = True
        lead[at[taken]], size[at[taken]] = at[k], n[k]
        gone, weight = g.of(taken), own[taken].astype(np.float64)
        left = ~taken
        at, n, own, g = at[left], n[left], own[left], g.of(left)
        less = np.zeros(len(at))
        for i, j in _tiles(len(weight), len(at)):
            less[j] += weight[i] @ gone.of(i).near(g.of(j)).astype(np.float64)
        n = n - less.astype(np.int64)
    size[at] = n
    return lead, size


def star_cluster_table(items: DataFrame, threshold: float = 0.88, n: int = 8, rows: int = 8) -> DataFrame:
    """:func:`star_clusters` of fingerprints (``id, search, grid``; each id once), without weights; pairs are of one search band.

    Pairs are never written, as their number grows with the square of the items: likeness is worked out where it is
    needed. Equal grids of a band have the same neighbours and go together, so they are one row that counts so often. Neighbours
    are counted by pairs of blocks in as many tasks; the choices of a band then run in one task, which holds its distinct
    grids, some 50 bytes each; sums within groups are again taken by pairs of blocks.
    """
    tasks, keep = _tasks(items), F.col("grid").isNotNull() & F.col("search").isNotNull() & F.col("id").isNotNull()
    x, xw, xd = _packed(items.filter(keep).select("id", "search", "grid"), n, rows, "a_")
    self_ = F.when(F.greatest(F.lit(0), *[F.bit_count(c) for c in xw]) == 0, 0.0).otherwise(1.0)
    alone = F.when(self_ < threshold, F.col("a_id"))  # an empty grid is not even like itself
    same = Window.partitionBy("a_search", *xw, alone)
    x = written(x.withColumns({"self": self_, "of": F.min("a_id").over(same)}))
    grids = written(x.groupBy("of").agg(F.count(F.lit(1)).alias("a_m"), *[F.first(c).alias(c) for c in ("a_search", "self", *xw, *xd)]).withColumnRenamed("of", "a_id"))
    counted = grids.join(_pair_sums(grids, ["a_search"], xw, xd, threshold, tasks).withColumnRenamed("id", "a_id"), "a_id").withColumn("n", F.col("s").cast("long") + F.col("a_m") - 1).drop("s")
    kind = x.schema["a_id"].dataType
    schema = T.StructType([T.StructField("a_id", kind), T.StructField("lead", kind), T.StructField("n", T.LongType())])

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("a_id")  # of equals the lesser id
        lead, size = _stars(_Grids(_bits(t, xw), _bits(t, xd), threshold), t["n"].to_numpy(), t["a_m"].to_numpy())
        return pa.table({"a_id": t["a_id"], "lead": t["a_id"].take(pa.array(lead)), "n": size})

    taken = written(counted.repartition(tasks, "a_search").groupBy("a_search").applyInArrow(run, schema))
    member = grids.join(taken, "a_id")
    several = taken.groupBy("lead").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("lead")
    sums = _pair_sums(member.join(several, "lead", "left_semi"), ["lead"], xw, xd, None, tasks).withColumnRenamed("id", "a_id")
    total = F.coalesce("s", F.lit(0.0)) + (F.col("a_m") - 1) * F.col("self")
    mean = F.round((total + 1) / (F.col("n") + 1), 4)
    best = F.max(F.struct(mean.alias("m"), (-F.col("a_id")).alias("o"), F.col("a_id").alias("id"))).alias("r")
    groups = member.join(sums, "a_id", "left").groupBy("lead").agg(best, F.first("n").alias("n")).select("lead", "n", F.col("r.id").alias("representative"))
    lone = items.filter(~keep).select(F.col("id").alias("lead"), F.lit(0).cast("long").alias("n"), F.col("id").alias("representative"))
    numbered = groups.unionByName(lone).withColumn("group_no", F.row_number().over(Window.orderBy(F.desc("n"), "lead")).cast("long"))  # one row a group
    of = x.select(F.col("a_id").alias("id"), F.col("of").alias("a_id")).join(taken.select("a_id", "lead"), "a_id").select("lead", "id")
    of = of.unionByName(items.filter(~keep).select(F.col("id").alias("lead"), "id"))
    return of.join(numbered, "lead").select("group_no", "representative", "id")
