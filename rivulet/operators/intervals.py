"""Interval operators: union length, coverage, runs, collinear rules. One window pass each; groups never meet.

Intervals without an end come after those with one, as in the SQL forms; before them, they would begin runs of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ordered(keys: list[str], order: list[str]) -> Window:
    return Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])


def _before(keys: list[str], order: list[str]) -> Window:
    return _ordered(keys, order).rowsBetween(Window.unboundedPreceding, -1)


def with_new_length(df: DataFrame, keys: list[str], lo: str = "lo", hi: str = "hi", out: str = "fresh") -> DataFrame:
    """Adds the length each interval adds to the union of those before it."""
    reach = F.max(hi).over(_before(keys, [lo, hi]))
    return df.withColumn(out, F.greatest(F.lit(0.0), F.col(hi) - F.greatest(F.col(lo), F.coalesce(reach, F.col(lo)))))


def union_length(df: DataFrame, keys: list[str], lo: str = "lo", hi: str = "hi") -> DataFrame:
    """``keys..., covered``: length of the union of the intervals of each group."""
    return with_new_length(df, keys, lo, hi).groupBy(*keys).agg(F.sum("fresh").alias("covered"))


def coverage(df: DataFrame, keys: list[str], a: Column, b: Column, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """``keys..., covered``: how much of [a, b] the intervals cover; groups that only touch it give 0."""
    cut = df.withColumns({"__lo": F.greatest(F.col(lo), a), "__hi": F.least(F.col(hi), b)}).withColumn("__hi", F.greatest("__lo", "__hi"))
    return union_length(cut, keys, "__lo", "__hi")


def runs(df: DataFrame, keys: list[str], tol: float = 0.0, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """``keys..., run, lo, hi, n``: intervals merged over gaps of up to ``tol`` (gaps and islands)."""
    reach = F.max(hi).over(_before(keys, [lo, hi]))
    named = df.withColumn("__new", (reach.isNull() | (F.col(lo) > reach + tol)).cast("int"))
    named = named.withColumn("run", F.sum("__new").over(_ordered(keys, [lo, hi]).rowsBetween(Window.unboundedPreceding, 0)))
    return named.groupBy(*keys, "run").agg(F.min(lo).alias("lo"), F.max(hi).alias("hi"), F.count(F.lit(1)).alias("n"))


def collinear(df: DataFrame, keys: list[str], min_len, bin_size: float = 0.4, coord: str = "coord", lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Segments of one coordinate bin as one rule: ``keys..., bin, lo, hi, coord, covered``.

    Bins are fixed (rounded half to even). The threshold is on the covered length; the extent spans gaps.
    """
    binned = df.withColumn("bin", F.rint(F.col(coord) / bin_size).cast("long"))
    fresh = with_new_length(binned, [*keys, "bin"], lo, hi)
    return fresh.groupBy(*keys, "bin").agg(
        F.min(lo).alias("lo"), F.max(hi).alias("hi"), F.avg(coord).alias("coord"), F.sum("fresh").alias("covered")
    ).filter(F.col("covered") >= min_len)


def bands(occupied: DataFrame, keys: list[str], min_gap: int, min_len: int, cell: str = "cell") -> DataFrame:
    """Runs of occupied cells: ``keys..., band, first, last, wide``.

    Runs nearer than ``min_gap`` cells merge, runs of up to ``min_len`` cells go, and a run over 1.5 times the upper
    median length is ``wide`` if there is more than one.
    """
    w = Window.partitionBy(*keys).orderBy(cell)
    gap = F.col(cell) - F.lag(cell).over(w) - 1
    cut = occupied.select(*keys, cell).distinct().withColumn("__new", (gap.isNull() | (gap >= F.greatest(F.lit(1), F.lit(min_gap)))).cast("int"))
    out = cut.withColumn("band", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*keys, "band").agg(F.min(cell).alias("first"), F.max(cell).alias("last"))
    out = out.withColumn("len", F.col("last") - F.col("first") + 1).filter(F.col("len") > min_len)
    every, rank = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("len", "first")
    out = out.withColumns({"__n": F.count(F.lit(1)).over(every), "__r": F.row_number().over(rank)})
    median = F.max(F.when(F.col("__r") == F.floor(F.col("__n") / 2) + 1, F.col("len"))).over(every)
    return out.withColumn("wide", (F.col("__n") > 1) & (F.col("len") > 1.5 * median)).select(*keys, "band", "first", "last", "wide")


def meet(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """All overlaps of the intervals of two lists: ``keys..., lo, hi``."""
    x, y = a.select(*keys, F.col("lo").alias("a0"), F.col("hi").alias("a1")), b.select(*keys, F.col("lo").alias("b0"), F.col("hi").alias("b1"))
    return x.join(y, keys).select(*keys, F.greatest("a0", "b0").alias("lo"), F.least("a1", "b1").alias("hi")).filter("hi > lo")


def nth_from_edge(df: DataFrame, keys: list[str], value: str, n: int = 2, tol: float = 1.5) -> DataFrame:
    """``keys..., value``: the n-th distinct line, lines within ``tol`` of the last one kept counting once."""
    kept = collapse_close(df, keys, value, tol)
    w = Window.partitionBy(*keys).orderBy(value)
    return kept.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") == n).select(*keys, value)


def collapse_close(df: DataFrame, keys: list[str], value: str, tol: float = 1.5) -> DataFrame:
    """Double lines as one: a value stays if it lies more than ``tol`` from the last one that stayed.

    The rule looks at kept values, so it is a fold over each group's sorted values, not a ``lag``.
    """
    kept = F.aggregate(
        F.array_sort(F.collect_set(value)),
        F.array().cast("array<double>"),
        lambda out, v: F.when((F.size(out) == 0) | (v - F.element_at(out, -1) > tol), F.concat(out, F.array(v))).otherwise(out),
    )
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(kept.alias("__kept")).select(*keys, F.explode("__kept").alias(value))


def gap_chains(df: DataFrame, keys: list[str], value: str, max_gap: float, least: int = 3) -> DataFrame:
    """``keys..., first, last, n``: chains of values with gaps under ``max_gap`` and at least ``least`` members."""
    w = Window.partitionBy(*keys).orderBy(value)
    new = F.coalesce((F.col(value) - F.lag(value).over(w) >= max_gap).cast("int"), F.lit(1))
    named = df.withColumn("__new", new).withColumn("__c", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return named.groupBy(*keys, "__c").agg(F.min(value).alias("first"), F.max(value).alias("last"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).drop("__c")


def equal_pitch(values: Column) -> Column:
    """Runs ``first, last, pitch, n`` of equally spaced values in a sorted array of distinct ones.

    A run has three values at least, and one stray value may lie between two of them; ``n`` counts strays as well. The
    tolerance is the greater of 0.8 and 12 % of the pitch. One fold: the state is the run so far and the stray value
    that waits for the next one; where a run ends, its last value and the stray begin another.
    """
    number = F.lit(None).cast("double")
    run = lambda first, last, pitch, n: F.struct(first.alias("first"), last.alias("last"), pitch.alias("pitch"), n.cast("long").alias("n"))

    def state(first, last, pitch, n, good, stray, runs):
        return F.struct(first.alias("first"), last.alias("last"), pitch.alias("pitch"), n.cast("long").alias("n"), good.cast("long").alias("good"), stray.alias("stray"), runs.alias("runs"))

    none = F.array().cast("array<struct<first:double,last:double,pitch:double,n:bigint>>")
    ended = lambda s: F.when(s["good"] >= 3, F.concat(s["runs"], F.array(run(s["first"], s["last"], s["pitch"], s["n"])))).otherwise(s["runs"])

    def step(s, y):
        near = lambda at, pitch: F.abs(y - at - pitch) <= F.greatest(F.lit(0.8), 0.12 * pitch)
        longer = state(s["first"], y, s["pitch"], s["n"] + 1 + s["stray"].isNotNull().cast("int"), s["good"] + 1, number, s["runs"])
        fresh = s["stray"] - s["last"]  # the pitch of the run that the stray value begins
        again = F.when(near(s["stray"], fresh), state(s["last"], y, fresh, F.lit(3), F.lit(3), number, ended(s))).otherwise(state(s["last"], s["stray"], fresh, F.lit(2), F.lit(2), y, ended(s)))
        waits = state(s["first"], s["last"], s["pitch"], s["n"], s["good"], y, s["runs"])
        begun = F.when(s["last"].isNull(), state(y, y, number, F.lit(1), F.lit(1), number, none)).otherwise(state(s["first"], y, y - s["first"], F.lit(2), F.lit(2), number, none))
        return F.when(s["pitch"].isNull(), begun).when(near(s["last"], s["pitch"]), longer).when(s["stray"].isNotNull(), again).otherwise(waits)

    return F.aggregate(values, state(number, number, number, F.lit(0), F.lit(0), number, none), step, ended)


def equal_pitch_runs(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys..., first, last, pitch, n`` of each group: a fold over its sorted distinct values."""
    values = df.groupBy(*keys).agg(F.array_sort(F.collect_set(F.col(value).cast("double"))).alias("__v"))
    return values.select(*keys, F.inline(equal_pitch(F.col("__v"))))


def visual_rows(df: DataFrame, keys: list[str], y: str, x: str, text: str, within: float = 2.0) -> DataFrame:
    """``keys..., row, line``: words grouped by distance from the row's first word, then left to right.

    Words without a height are rows of their own. The fold sees the distinct heights of a group and keeps those that begin
    a row; words are then numbered by a window in which these come as marks, so no array grows with the words.
    """
    w = df.select(*keys, F.col(y).cast("double").alias("__y"), F.col(x).cast("double").alias("__x"), F.col(text).alias("__t"))
    alone = F.col("__y").isNull() | F.isnan("__y")
    begin = F.aggregate(
        F.array_sort(F.collect_set("__y")),
        F.array().cast("array<double>"),
        lambda out, v: F.when((F.size(out) == 0) | (v - F.element_at(out, -1) >= within), F.concat(out, F.array(v))).otherwise(out),
    )
    number, string = F.lit(None).cast("double"), F.lit(None).cast("string")
    marks = w.filter(~alone).groupBy(*keys).agg(begin.alias("__b")).select(*keys, F.explode("__b").alias("__y"), number.alias("__x"), string.alias("__t"), F.lit(1).alias("__new"), F.lit(False).alias("__word"))
    every = w.withColumns({"__new": alone.cast("int"), "__word": F.lit(True)}).unionByName(marks)
    order = Window.partitionBy(*keys).orderBy("__y", "__word", "__x", "__t").rowsBetween(Window.unboundedPreceding, 0)
    placed = every.withColumn("row", F.sum("__new").over(order).cast("int")).filter("__word")
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("__x").alias("x"), F.col("__t").alias("t")))), lambda v: v["t"]), "  ")
    return placed.groupBy(*keys, "row").agg(line.alias("line"))
