"""Connected components of an edge table, by contraction."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import freeing, stored

#: Edges that a task reduces to stars at once.
FOREST = 200_000


class Sets:
    """Disjoint sets of integers; the root of each is its least member."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, v: int) -> int:
        up = self.up
        while (p := up.get(v, v)) != v:
            up[v] = v = up.get(p, p)
        return v

    def join(self, x: int, y: int) -> bool:
        """Whether ``x`` and ``y`` were apart."""
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of the edges ``a, b`` that connect what earlier ones do not."""
    sets = Sets()
    return np.array([i for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())) if sets.join(x, y)], np.int64)


def stars(edges: DataFrame, tasks: int) -> DataFrame:
    """Edges ``a, b`` with the components of ``edges``: ``b`` is the least vertex that a task's share connects ``a`` with.

    With one task, ``b`` is the least vertex of the component.
    """

    def reduce(batches):
        sets = Sets()
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sets.join(x, y)
        found = [(v, sets.find(v)) for v in list(sets.up)]
        a, b = zip(*[(v, r) for v, r in found if v != r]) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return edges.select("a", "b").repartition(tasks).mapInArrow(freeing(reduce), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``v, label`` for every vertex of ``edges`` (``a, b``; bigint): the least vertex of its component.

    Each round tasks of at most about ``FOREST`` edges reduce their share to stars. If one task held all, these are the
    components. Else every vertex is contracted into the one of least hash among itself and its neighbours, with another
    hash each round, which leaves the components as they are and a part of the vertices; edges that fell together go.
    The rounds' tables shrink, so that all rounds together cost little more than the first ones; each is written.
    """
    edges = stored(edges.select("a", "b"), "edges")
    alone = edges.filter("a = b").select(F.col("a").alias("v")).distinct()
    left, steps = edges.filter("a <> b"), []
    while True:
        tasks = left.count() // FOREST + 1
        left = stored(stars(left, tasks), "stars")
        if tasks == 1:
            break
        seen = F.min(F.struct(F.xxhash64("b", F.lit(len(steps))).alias("h"), "b"))
        ends = [("a", "b"), ("b", "a"), ("a", "a"), ("b", "b")]
        both = left.select(F.explode(F.array(*[F.struct(F.col(x).alias("v"), F.col(y).alias("b")) for x, y in ends])).alias("e")).select("e.v", "e.b")
        into = stored(both.groupBy("v").agg(seen.alias("m")).select("v", F.col("m.b").alias("into")), "into")
        steps.append(into)
        moved = left.join(into.withColumnsRenamed({"v": "a", "into": "x"}), "a").join(into.withColumnsRenamed({"v": "b", "into": "y"}), "b")
        left = stored(moved.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "contracted")
    labels = left.select(F.col("a").alias("v"), F.col("b").alias("label"))
    for into in reversed(steps):  # vertices that were contracted into others stand in the step as well
        last = labels.withColumnRenamed("v", "into")
        labels = stored(into.join(last, "into", "left").select("v", F.coalesce("label", "into").alias("label")), "labels")
    if steps:
        least = labels.groupBy("label").agg(F.min("v").alias("least"))
        labels = labels.join(least, "label").select("v", F.col("least").alias("label"))
    else:
        roots = labels.select(F.col("label").alias("v")).distinct()
        labels = labels.unionByName(roots.withColumn("label", F.col("v")))
    return labels.unionByName(alone.join(labels, "v", "left_anti").withColumn("label", F.col("v")))
