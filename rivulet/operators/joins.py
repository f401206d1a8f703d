"""Range joins by grid cells: pairs meet in an equi-join on cells, never in a nested loop.

A pair that shares several cells is kept in one only: the cell at the greater of the two first cells on each axis.
So nothing has to be made distinct afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions import geometry as G


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` hinted to meet others in a sort-merge join: exploded rows are many, but Spark estimates them as what they came from."""
    return df.hint("merge")


def _cells(df: DataFrame, prefix: str, cell: float, grow: float) -> DataFrame:
    at = lambda c, d: F.floor((F.col(f"{prefix}{c}") + d) / cell)
    df = df.withColumns({f"__{prefix}ix": at("x0", -grow), f"__{prefix}iy": at("y0", -grow)})
    return df.withColumn("__cx", F.explode(F.sequence(F.col(f"__{prefix}ix"), at("x1", grow)))).withColumn(
        "__cy", F.explode(F.sequence(F.col(f"__{prefix}iy"), at("y1", grow)))
    )


def box_join(left: DataFrame, right: DataFrame, keys: list[str], gap: float = 0.0, cell: float = 64.0, self_id: str | None = None) -> DataFrame:
    """Pairs of boxes no further apart than ``gap`` on either axis.

    ``left`` and ``right`` have ``keys`` and ``x0, y0, x1, y1``; every other column comes out as ``a_...`` and
    ``b_...``. With ``self_id`` each pair of a self-join comes once, the smaller id as a.
    """
    a = left.select(*keys, *[F.col(c).alias(f"a_{c}") for c in left.columns if c not in keys])
    b = right.select(*keys, *[F.col(c).alias(f"b_{c}") for c in right.columns if c not in keys])
    a, b = _cells(a, "a_", cell, gap), _cells(b, "b_", cell, 0.0)
    joined = a.join(shuffled(b), [*keys, "__cx", "__cy"]).filter(
        (F.col("__cx") == F.greatest("__a_ix", "__b_ix")) & (F.col("__cy") == F.greatest("__a_iy", "__b_iy")) & G.near(G.of("a_"), G.of("b_"), gap)
    )
    if self_id:
        joined = joined.filter(F.col(f"a_{self_id}") < F.col(f"b_{self_id}"))
    return joined.drop("__cx", "__cy", "__a_ix", "__a_iy", "__b_ix", "__b_iy")


def nearest(left: DataFrame, right: DataFrame, keys: list[str], id_: str, within: float, order: list[Column], cell: float = 64.0) -> DataFrame:
    """For each left row the first right row within ``within`` by (distance, ``order``); with ``distance``."""
    pairs = box_join(left, right, keys, within, cell).withColumn("distance", G.distance(G.of("a_"), G.of("b_"))).filter(F.col("distance") <= within)
    w = Window.partitionBy(*keys, f"a_{id_}").orderBy("distance", *order)
    return pairs.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def inside(left: DataFrame, right: DataFrame, keys: list[str], slack: float = 0.6, cell: float = 64.0, centre: bool = False) -> DataFrame:
    """Left boxes with every right rectangle that holds them (or their centres)."""
    pairs = box_join(left, right, keys, slack, cell)
    test = G.center_in if centre else G.contains
    return pairs.filter(test(G.of("b_"), G.of("a_"), slack))


def first_inside(left: DataFrame, right: DataFrame, keys: list[str], id_: str, order: str, **options) -> DataFrame:
    """The first right rectangle, by ``order``, that holds each left box."""
    hit = inside(left, right, keys, **options)
    w = Window.partitionBy(*keys, f"a_{id_}").orderBy(f"b_{order}")
    return hit.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def outside(left: DataFrame, right: DataFrame, keys: list[str], id_: str, **options) -> DataFrame:
    """Left boxes that no right rectangle holds (anti-join on containment)."""
    hit = inside(left.select(*keys, id_, *G.SIDES), right, keys, **options).select(*keys, F.col(f"a_{id_}").alias(id_)).distinct()
    return left.join(hit, [*keys, id_], "left_anti")


def best_overlap(left: DataFrame, right: DataFrame, keys: list[str], id_: str, other: str, within: float = 64.0, cell: float = 64.0) -> DataFrame:
    """For each left box the right one of largest overlap, else the nearest within reach: ``keys, id, other, overlap``."""
    pairs = box_join(left, right, keys, within, cell)
    pairs = pairs.withColumn("overlap", G.area(G.meet(G.of("a_"), G.of("b_")))).withColumn("distance", G.distance(G.of("a_"), G.of("b_")))
    w = Window.partitionBy(*keys, f"a_{id_}").orderBy(F.desc("overlap"), "distance", f"b_{other}")
    return pairs.withColumn("__r", F.row_number().over(w)).filter("__r = 1").select(*keys, F.col(f"a_{id_}").alias(id_), F.col(f"b_{other}").alias(other), "overlap", "distance")


def span_lines(points: DataFrame, lines: DataFrame, keys: list[str], id_: str, slack: float = 0.8) -> DataFrame:
    """The lines around each point's cell: ``keys, id, left, right, top, bottom`` (null where the page edge bounds it).

    ``points``: ``x, y``; ``lines``: ``orient, coord, lo, hi``. As-of like: of the lines whose span holds the point,
    the nearest on each side. Lines meet the points of their page only.
    """
    pairs = points.select(*keys, id_, "x", "y").join(shuffled(lines.select(*keys, "orient", "coord", "lo", "hi")), keys)
    along = F.when(F.col("orient") == "V", F.col("y")).otherwise(F.col("x"))
    hit = pairs.filter((F.col("lo") - slack <= along) & (F.col("hi") + slack >= along))
    v, h = F.col("orient") == "V", F.col("orient") == "H"
    c = F.col("coord")
    found = hit.groupBy(*keys, id_).agg(
        F.max(F.when(v & (c <= F.col("x")), c)).alias("left"),
        F.min(F.when(v & (c > F.col("x")), c)).alias("right"),
        F.max(F.when(h & (c <= F.col("y")), c)).alias("top"),
        F.min(F.when(h & (c > F.col("y")), c)).alias("bottom"),
    )
    return points.select(*keys, id_).join(found, [*keys, id_], "left")
