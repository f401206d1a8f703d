"""Accounting with multiplicity: bag differences, equality, order, duplicates, comparisons of runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def deficit(need: DataFrame, have: DataFrame, cols: list[str]) -> DataFrame:
    """``cols..., missing``: what ``have`` lacks of ``need``, with multiplicity; both sides combine before they shuffle."""
    n = need.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    h = have.groupBy(*cols).agg(F.count(F.lit(1)).alias("__h"))
    return n.join(h, cols, "left").select(*cols, (F.col("__n") - F.coalesce("__h", F.lit(0))).alias("missing")).filter("missing > 0")


def bag_equal(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    """One row: ``only_a, only_b, equal`` (rows with multiplicity; nulls equal each other)."""
    both = a.select(*cols, F.lit(1).alias("__s")).unionByName(b.select(*cols, F.lit(-1).alias("__s"))).groupBy(*cols).agg(F.sum("__s").alias("d"))
    out = both.agg(F.coalesce(F.sum(F.greatest("d", F.lit(0))), F.lit(0)).alias("only_a"), F.coalesce(F.sum(F.greatest(-F.col("d"), F.lit(0))), F.lit(0)).alias("only_b"))
    return out.withColumn("equal", (F.col("only_a") == 0) & (F.col("only_b") == 0))


def first_order(df: DataFrame, keys: list[str], value: str, pos: str) -> DataFrame:
    """Distinct values in the order of first appearance: ``keys..., value, first_pos, rank``."""
    out = df.groupBy(*keys, value).agg(F.min(pos).alias("first_pos"))
    return out.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("first_pos")))


def mode_first(df: DataFrame, keys: list[str], value: str, pos: str) -> DataFrame:
    """``keys..., value, n``: the commonest value, the first seen on ties."""
    n = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), F.min(pos).alias("p"))
    best = n.groupBy(*keys).agg(F.max(F.struct(F.col("n"), (-F.col("p")).alias("p"), F.col(value).alias("v"))).alias("b"))
    return best.select(*keys, F.col("b.v").alias(value), F.col("b.n").alias("n"))


def tallied(items: Column) -> Column:
    """Each distinct value of an array of ``word, pos``, sorted by both: ``word, n, first_pos``, by value.

    A run of equal values begins where the one before differs; its length is the way to where the next one begins.
    """
    begins = F.filter(F.transform(items, lambda x, i: i), lambda i: (i == 0) | (F.get(items, i)["word"] != F.get(items, i - 1)["word"]))
    ends = F.concat(F.filter(begins, lambda i: i > 0), F.array(F.size(items)))
    return F.transform(
        F.filter(F.arrays_zip(begins.alias("a"), ends.alias("b")), lambda r: r["a"].isNotNull()),
        lambda r: F.struct(F.get(items, r["a"])["word"].alias("word"), (r["b"] - r["a"]).cast("long").alias("n"), F.get(items, r["a"])["pos"].alias("first_pos")),
    )


def first_order_within(df: DataFrame, keys: list[str], items: str, value: str) -> DataFrame:
    """``first_order`` of rows that hold a key's values in one array (``word, pos``, sorted): nothing is shuffled."""
    t = df.select(*keys, F.col(items).alias("__i")).withColumn("__t", tallied(F.col("__i")))
    order = F.array_sort(F.transform("__t", lambda x: F.struct(x["first_pos"].alias("first_pos"), x["word"].alias("word"))))
    return t.select(*keys, F.posexplode(order).alias("__r", "__w")).select(*keys, F.col("__w.word").alias(value), F.col("__w.first_pos").alias("first_pos"), (F.col("__r") + 1).alias("rank"))


def mode_first_within(df: DataFrame, keys: list[str], items: str, value: str) -> DataFrame:
    """``mode_first`` of rows that hold a key's values in one array (``word, pos``, sorted): nothing is shuffled."""
    best = F.array_max(F.transform(tallied(F.col(items)), lambda x: F.struct(x["n"].alias("n"), (-x["first_pos"]).alias("p"), x["word"].alias("v"))))
    return df.select(*keys, best.alias("b")).select(*keys, F.col("b.v").alias(value), F.col("b.n").alias("n"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def compare_runs(base: DataFrame, now: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """``keys..., verdict``: SAME, DIFF, MISSING (only in base) or NEW, by null-safe comparison of ``cols``."""
    a = base.select(*keys, F.struct(*cols).alias("__a"), F.lit(True).alias("__in_a"))
    b = now.select(*keys, F.struct(*cols).alias("__b"), F.lit(True).alias("__in_b"))
    verdict = F.when(F.col("__in_b").isNull(), "MISSING").when(F.col("__in_a").isNull(), "NEW").when(F.col("__a").eqNullSafe(F.col("__b")), "SAME").otherwise("DIFF")
    return a.join(b, keys, "full_outer").select(*keys, verdict.alias("verdict"))


def inversions(df: DataFrame, keys: list[str], before: str, after: str) -> DataFrame:
    """``keys..., inversions``: pairs of a group whose order by ``before`` turns round by ``after``.

    A group is folded over its sorted values; counting needs the group's values together, so groups are bounded units
    such as a page.
    """
    sorted_ = F.transform(F.array_sort(F.collect_list(F.struct(F.col(before).alias("b"), F.col(after).alias("a")))), lambda x: x)
    count = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.size("__s"), F.lit(1))),
        F.lit(0).cast("long"),
        lambda s, i: s + F.size(F.filter("__s", lambda y: (y["b"] > F.element_at("__s", i)["b"]) & (y["a"] < F.element_at("__s", i)["a"]))),
    )
    return df.groupBy(*keys).agg(sorted_.alias("__s")).select(*keys, count.alias("inversions"))


def last_wins(df: DataFrame, key: str, pos: str) -> DataFrame:
    """One row a key: the last one."""
    kept = df.groupBy(key).agg(F.max(F.struct(F.col(pos).alias("__p"), F.struct(*[c for c in df.columns]).alias("r"))).alias("m"))
    return kept.select("m.r.*")


def exactly_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left`` rows with how many rows of ``right`` match them and whether that is exactly one."""
    n = right.groupBy(key).agg(F.count(F.lit(1)).alias("matches"))
    return left.join(n, key, "left").withColumn("matches", F.coalesce("matches", F.lit(0))).withColumn("ok", F.col("matches") == 1)


def violations(df: DataFrame, key: list[str], rules: dict[str, Column]) -> DataFrame:
    """``key..., rule`` for each rule a row breaks; a null condition counts as broken."""
    broken = F.array(*[F.when(F.coalesce(c, F.lit(False)), None).otherwise(F.lit(n)) for n, c in rules.items()])
    return df.select(*key, F.explode(F.filter(broken, lambda x: x.isNotNull())).alias("rule"))


def all_ok(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def index_quantile(df: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """``keys..., value``: the value at index floor(share * n) of the sorted group (not interpolated)."""
    w = Window.partitionBy(*keys)
    ranked = df.withColumns({"__n": F.count(F.lit(1)).over(w), "__r": F.row_number().over(w.orderBy(value)) - 1})
    at = F.least(F.floor(F.col("__n") * share), F.col("__n") - 1)
    return ranked.filter(F.col("__r") == at).select(*keys, value)
