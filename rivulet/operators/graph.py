"""Components and reachability of proximity graphs, as rounds of joins over written tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions import geometry as G
from rivulet.operators import joins


def shared_folder(spark: SparkSession) -> str:
    """A new name in the folder of ``spark.checkpoint.dir``, which the driver and all executors see."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:  # a local folder serves only where all tasks run in this process
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "/tmp/checkpoints"
    return f"{base.rstrip('/')}/rivulet-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder of ``spark.checkpoint.dir``: cuts lineage, outlives executors."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``v, comp``: the least vertex of each vertex' component; ``edges`` has ``a, b``.

    Every round takes the least label of the neighbours and of one's own label's vertex, so long chains shorten
    by more than a step a round.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(vertices.select("v").distinct().join(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("n")), "v", "left").select("v", F.least("v", F.coalesce("n", "v")).alias("comp")))
    while True:
        near = both.join(labels.withColumnRenamed("v", "b"), "b").groupBy(F.col("a").alias("v")).agg(F.min("comp").alias("near"))
        root = labels.select(F.col("v").alias("comp"), F.col("comp").alias("root"))
        step = labels.join(near, "v", "left").join(root, "comp").select("v", "comp", F.least("comp", F.coalesce("near", "comp"), "root").alias("new"))
        done = written(step)
        labels = done.select("v", F.col("new").alias("comp"))
        if not done.filter("new <> comp").limit(1).count():
            return labels


def box_components(boxes: DataFrame, keys: list[str], id_: str, gap: float, more: DataFrame | None = None) -> DataFrame:
    """``v, comp`` of boxes within ``gap`` of each other on both axes; ``more``: further edges (must-link)."""
    edges = joins.box_join(boxes, boxes, keys, gap, self_id=id_).select(F.col(f"a_{id_}").alias("a"), F.col(f"b_{id_}").alias("b"))
    if more is not None:
        edges = edges.unionByName(more.select("a", "b"))
    return components(boxes.select(F.col(id_).alias("v")), edges)


def must_link(members: DataFrame, group: str, id_: str) -> DataFrame:
    """Edges that tie all members of a group to its least member: a star, not all pairs."""
    least = members.groupBy(group).agg(F.min(id_).alias("a"))
    return members.join(least, group).filter(F.col(id_) > F.col("a")).select("a", F.col(id_).alias("b")).distinct()


def reachable(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """``v`` of all vertices a chain of edges ties to a seed, the seeds among them."""
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    seen = written(seeds.select("v").distinct())
    front = seen
    while True:
        front = written(front.join(both, front["v"] == both["a"]).select(F.col("b").alias("v")).distinct().join(seen, "v", "left_anti"))
        if not front.limit(1).count():
            return seen
        seen = written(seen.unionByName(front))


def merge_overlapping(blocks: DataFrame, keys: list[str], id_: str, share: float = 0.2, exempt: str | None = None) -> DataFrame:
    """``keys, block, x0, y0, x1, y1, n``: blocks merged while two overlap by over ``share`` of the smaller one.

    A merged box grows and may meet others, so rounds of pairs, components and new boxes go on until none merge.
    Blocks whose ``exempt`` column is true neither merge nor grow. The closure does not depend on an order. Ids are unique over all keys.
    """
    now = blocks.select(*keys, F.col(id_).alias("block"), *G.SIDES, F.lit(1).cast("long").alias("n"), (F.col(exempt) if exempt else F.lit(False)).alias("fixed"))
    now = written(now)
    while True:
        free = now.filter("not fixed")
        pairs = joins.box_join(free.select(*keys, "block", *G.SIDES), free.select(*keys, "block", *G.SIDES), keys, self_id="block")
        small = F.least(G.area(G.of("a_")), G.area(G.of("b_")))
        edges = written(pairs.filter(G.area(G.meet(G.of("a_"), G.of("b_"))) > share * small).select(F.col("a_block").alias("a"), F.col("b_block").alias("b")))
        if not edges.limit(1).count():
            return now.drop("fixed")
        comp = components(edges.select(F.col("a").alias("v")).unionByName(edges.select(F.col("b").alias("v"))), edges)
        named = now.join(comp.withColumnRenamed("v", "block"), "block", "left").withColumn("block", F.coalesce("comp", "block"))
        now = written(
            named.groupBy(*keys, "block").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.sum("n").alias("n"), F.max("fixed").alias("fixed"))
        )
