"""Choosing among ordered candidates, placements, and coverage accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions import geometry as G


def first_feasible(df: DataFrame, keys: list[str], feasible: Column, rank: str, ties: list[str] | None = None) -> DataFrame:
    """The first candidate that is feasible, by rank, for each key; keys without one are left out.

    A candidate without a rank comes after all others. Of equal ranks the first by ``ties`` (columns that are dropped), else any.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(rank).asc_nulls_last(), *(ties or []))
    return df.filter(feasible).withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r", *(ties or []))


def pick_variant(df: DataFrame, keys: list[str], plain: str, variant: str, keep: float = 0.97, auto: str | None = None, keep_auto: float = 0.90) -> DataFrame:
    """``choice``: the variant if its size is at least ``keep`` (``keep_auto`` where ``auto``) of the plain one's."""
    least = F.when(F.col(auto), keep_auto).otherwise(keep) if auto else F.lit(keep)
    return df.withColumn("choice", F.when(F.coalesce(F.col(variant) >= least * F.col(plain), F.lit(False)), "variant").otherwise("plain"))


def ladder(df: DataFrame, keys: list[str], length: str, width: str, sizes: list[float], per_point: float = 0.5) -> DataFrame:
    """``keys..., size``: the first font size of a ladder at which the text fits the width; null if none."""
    fits = F.filter(F.array(*[F.lit(float(s)) for s in sizes]), lambda s: F.col(length) * per_point * s <= F.col(width))
    return df.select(*keys, F.get(fits, 0).alias("size"))


def columns(df: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """Ordered rows dealt round robin to n columns: ``column`` (from 0) and ``line`` (from 0)."""
    i = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    return df.withColumns({"column": F.pmod(i, F.lit(n)), "line": F.floor(i / n).cast("int")})


def placements(clips: DataFrame, keys: list[str]) -> DataFrame:
    """Target boxes: each clip moves with its group's origin (the least corner of all its clips).

    ``clips``: ``keys, x0, y0, x1, y1, dst_x, dst_y, scale``.
    """
    w = Window.partitionBy(*keys)
    ox, oy, s = F.min("x0").over(w), F.min("y0").over(w), F.col("scale")
    return clips.withColumns(
        {"t_x0": G.place(F.col("x0"), ox, F.col("dst_x"), s), "t_y0": G.place(F.col("y0"), oy, F.col("dst_y"), s), "t_x1": G.place(F.col("x1"), ox, F.col("dst_x"), s), "t_y1": G.place(F.col("y1"), oy, F.col("dst_y"), s)}
    )


def cells(boxes: DataFrame, keys: list[str], size: float) -> DataFrame:
    """The distinct grid cells boxes cover: ``keys..., ix, iy``."""
    at = lambda c: F.floor(F.col(c) / size)
    out = boxes.withColumn("ix", F.explode(F.sequence(at("x0"), at("x1")))).withColumn("iy", F.explode(F.sequence(at("y0"), at("y1"))))
    return out.select(*keys, "ix", "iy").distinct()


def uncovered(interest: DataFrame, covers: list[DataFrame], keys: list[str]) -> DataFrame:
    """Cells of interest that none of the covers holds; a complete account leaves none."""
    for c in covers:
        interest = interest.join(c.select(*keys, "ix", "iy").distinct(), [*keys, "ix", "iy"], "left_anti")
    return interest


def triage(df: DataFrame, flags: str, failed: Column, review: list[str]) -> DataFrame:
    """``triage, review_flags``: EXCEPTION where it failed, REVIEW where a flag starts with one of ``review``, else AUTO_OK."""
    prefixes = F.array(*[F.lit(x) for x in review])
    hit = F.array_sort(F.array_distinct(F.filter(F.coalesce(F.col(flags), F.array().cast("array<string>")), lambda f: F.exists(prefixes, lambda p: F.startswith(f, p)))))
    return df.withColumn("review_flags", hit).withColumn("triage", F.when(failed, "EXCEPTION").when(F.size("review_flags") > 0, "REVIEW").otherwise("AUTO_OK"))


def side_or_main(boxes: DataFrame, x0: Column, width: Column, at: float = 0.58) -> DataFrame:
    """``part``: rail for boxes whose centre lies beyond ``at`` of the content width, else view."""
    centre = (F.col("x0") + F.col("x1")) / 2
    return boxes.withColumn("part", F.when(centre > x0 + at * width, "rail").otherwise("view"))


def displaced(pairs: DataFrame, tol: float = 2.0) -> DataFrame:
    """Pairs of placed blocks that moved differently: ``shift`` over ``tol``."""
    dx = (F.col("a_dst_x") - F.col("a_x0")) - (F.col("b_dst_x") - F.col("b_x0"))
    dy = (F.col("a_dst_y") - F.col("a_y0")) - (F.col("b_dst_y") - F.col("b_y0"))
    return pairs.withColumn("shift", F.sqrt(dx * dx + dy * dy)).filter(F.col("shift") > tol)


def dominated(boxes: DataFrame, keys: list[str], id_: str) -> DataFrame:
    """Boxes that lie inside no other one (equal boxes: the least id stays)."""
    from rivulet.operators import joins

    b = boxes.select(*keys, id_, *G.SIDES)
    pair = joins.box_join(b, b, keys)
    same = (G.area(G.of("a_")) == G.area(G.of("b_"))) & G.contains(G.of("a_"), G.of("b_"))
    inside = pair.filter((F.col(f"a_{id_}") != F.col(f"b_{id_}")) & G.contains(G.of("b_"), G.of("a_")) & (~same | (F.col(f"b_{id_}") < F.col(f"a_{id_}"))))
    gone = inside.select(*keys, F.col(f"a_{id_}").alias(id_)).distinct()
    return boxes.join(gone, [*keys, id_], "left_anti")
