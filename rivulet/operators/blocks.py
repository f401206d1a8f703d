"""Rules on groups of primitives: statistics in one aggregate, then plain conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions import geometry as G


def stats(members: DataFrame, keys: list[str]) -> DataFrame:
    """Per block from its members' boxes: extent, counts, shares of small and long members, lengths against width."""
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    size = F.greatest(w, h)
    return members.groupBy(*keys).agg(
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count(F.lit(1)).alias("n"),
        F.avg((size < 9).cast("int")).alias("small"), F.count_if(size >= 30).alias("long"), F.max(size).alias("largest"), F.count_if(h < 2).alias("flat"),
    )


def table_like(members: DataFrame, keys: list[str], share: float = 0.6, least: int = 3) -> DataFrame:
    """``keys..., rules, is_table``: blocks with ``least`` or more flat members longer than ``share`` of the width."""
    width = F.max("x1").over(Window.partitionBy(*keys)) - F.min("x0").over(Window.partitionBy(*keys))
    flat = (F.col("y1") - F.col("y0") < 2) & (F.col("x1") - F.col("x0") > share * F.col("__w"))
    return members.withColumn("__w", width).groupBy(*keys).agg(F.count_if(flat).alias("rules")).withColumn("is_table", F.col("rules") >= least)


def text_like(members: DataFrame, keys: list[str], content_width: float, share: float = 0.95) -> DataFrame:
    """``keys..., tiny, is_text``: nearly all members under 2 % of the content width."""
    tiny = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) < 0.02 * content_width
    return members.groupBy(*keys).agg(F.avg(tiny.cast("int")).alias("tiny")).withColumn("is_text", F.col("tiny") >= share)


def outlined_text(block_stats: DataFrame) -> Column:
    """Lettering drawn as outlines: over 40 members, 98 % of them small, none long."""
    return (F.col("n") > 40) & (F.col("small") >= 0.98) & (F.col("long") == 0)


def stray(block_stats: DataFrame) -> Column:
    """At most two members, or at most six in a band under 2 high or wide."""
    band = F.least(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) < 2
    return (F.col("n") <= 2) | ((F.col("n") <= 6) & band)


def slanted(segments: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., lines, slanted, directions, is_3d`` from ``dx, dy`` of long lines.

    A view in three dimensions: over 12 lines, 30 % slanted, three direction buckets with 8 % of the lines each.
    """
    b = segments.withColumn("bucket", G.slant_bucket(F.col("dx"), F.col("dy")))
    b = b.withColumn("tilt", (F.abs("dx") > 0.15 * F.abs("dy")) & (F.abs("dy") > 0.15 * F.abs("dx")))
    per = b.groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("n"), F.count_if("tilt").alias("t"))
    total = F.sum("n").over(Window.partitionBy(*keys))
    per = per.withColumn("big", (F.col("n") >= 0.08 * total).cast("int"))
    out = per.groupBy(*keys).agg(F.sum("n").alias("lines"), F.sum("t").alias("slanted"), F.sum("big").alias("directions"))
    return out.withColumn("is_3d", (F.col("lines") > 12) & (F.col("slanted") >= 0.3 * F.col("lines")) & (F.col("directions") >= 3))


def masks(paths: DataFrame, keys: list[str], reach: int = 79, least: int = 2) -> DataFrame:
    """``keys..., seq, later``: white boxes with at least ``least`` later other paths inside, among the next ``reach``.

    ``paths``: ``keys, seq, is_white, x0, y0, x1, y1``. Paint order is cut into bins as wide as the reach, so each
    box meets two bins of its page in an equi-join.
    """
    bin_ = lambda c: F.floor(c / (reach + 1))
    a = paths.filter("is_white").select(*keys, "seq", *[F.col(s).alias(f"a_{s}") for s in G.SIDES], F.explode(F.array(bin_(F.col("seq")), bin_(F.col("seq")) + 1)).alias("__b"))
    b = paths.filter("not is_white").select(*keys, F.col("seq").alias("s2"), *[F.col(s).alias(f"b_{s}") for s in G.SIDES], bin_(F.col("seq")).alias("__b"))
    hit = a.join(b, [*keys, "__b"]).filter(F.col("s2").between(F.col("seq") + 1, F.col("seq") + reach) & G.contains(G.of("a_"), G.of("b_"), 0.5))
    return hit.groupBy(*keys, "seq").agg(F.count(F.lit(1)).alias("later")).filter(F.col("later") >= least)


def kind(text: Column, parts: Column, shapes: Column, table_words: Column, board_words: Column, performance_words: Column) -> Column:
    """table, pcb, performance or view; the first that fits."""
    has = lambda ws: F.exists(ws, lambda w: F.contains(text, w))
    return F.when(has(table_words) | (parts >= 2), "table").when(has(board_words), "pcb").when(has(performance_words) & (shapes <= 12), "performance").otherwise("view")


def body_colour(paths: DataFrame, keys: list[str], colour: str, order: str, share: float = 0.15) -> DataFrame:
    """``keys..., neutral_share, body``: the commonest other colour where neutrals are under ``share`` of the paths.

    Of equally common colours the one seen first in ``order``.
    """
    n = paths.groupBy(*keys, colour).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"), F.max("is_neutral").alias("neutral"))
    out = n.groupBy(*keys).agg(
        (F.sum(F.when(F.col("neutral"), F.col("n")).otherwise(0)) / F.sum("n")).alias("neutral_share"),
        F.max(F.when(~F.col("neutral"), F.struct(F.col("n"), (-F.col("first")).alias("o"), F.col(colour).alias("c")))).alias("m"),
    )
    return out.select(*keys, "neutral_share", F.when(F.col("neutral_share") < share, F.col("m.c")).alias("body"))


def border_gaps(rows: DataFrame, rules: DataFrame, keys: list[str], aligned: float = 1.0, least: int = 3, covered: float = 0.95) -> DataFrame:
    """Table sides to restore: ``keys..., x, lo, hi, share`` where ``least`` or more row rules end together.

    ``rows``: row rules ``coord, lo, hi``; ``rules``: vertical rules ``coord, lo, hi``. A side at the rounded common end
    is missing if vertical rules there cover under ``covered`` of it.
    """
    ends = rows.select(*keys, F.explode(F.array("lo", "hi")).alias("e"), "coord").withColumn("x", F.rint(F.col("e") / aligned) * aligned)
    sides = ends.groupBy(*keys, "x").agg(F.min("coord").alias("lo"), F.max("coord").alias("hi"), F.count_distinct("coord").alias("n")).filter(F.col("n") >= least)
    v = rules.select(*keys, (F.rint(F.col("coord") / aligned) * aligned).alias("x"), F.col("lo").alias("v0"), F.col("hi").alias("v1"))
    cut = sides.join(v, [*keys, "x"], "left").withColumns({"a": F.greatest("v0", "lo"), "b": F.least("v1", "hi")})
    w = Window.partitionBy(*keys, "x").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0.0), F.col("b") - F.greatest(F.col("a"), F.coalesce(F.max("b").over(w), F.col("a"))))
    out = cut.withColumn("f", F.coalesce(fresh, F.lit(0.0))).groupBy(*keys, "x", "lo", "hi").agg(F.sum("f").alias("c"))
    return out.withColumn("share", F.col("c") / (F.col("hi") - F.col("lo"))).filter((F.col("hi") > F.col("lo")) & (F.col("share") < covered)).drop("c")
