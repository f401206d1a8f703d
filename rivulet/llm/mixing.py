"""Op 10: mixing sources to target weights by pivotal dependent rounding.

Each source gets a target number of words by its weight, at most ``max_copies`` times its size, the excess reshared
by weight. Every document of a source starts with the same number of copies target / size, of which the fraction is
settled by the pivotal method: two fractional units meet, and at random one gives its mass to the other until one
of them is 0 or 1, which keeps the sum and each unit's expectation. Units meet in small bundles of documents of like
length, so the words taken stay near the target as well as the number of copies; each bundle leaves one fractional
unit at most, and these residuals meet again in bundles one level up, until a source has one left: a reduction tree
with about log(n) levels. Every random draw is a hash of the seed and the two units, so reruns agree.

Plan. One pass counts words; only (key, source, size) are shuffled. A bundle is a hash bucket inside one (source,
size class), so a source with a third of all rows spreads over as many tasks as any other. The upper levels hold
``1 / bundle`` of the level below.

Defined results. Null text: size 0, null source: a source of its own, last in order. A source of size 0 gets target 0
and no copies. An empty table gives an empty result. Repeated rows are units of their own. Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import let, n_words, sized, stored, table

#: Residual masses this near to 0 or 1 are float noise.
EPS = 1e-9


def source_targets(
    sizes: DataFrame, weights: tuple = (5.0, 2.0, 1.0), max_copies: float = 3.0, size: str = "size", source: str = "source"
) -> DataFrame:
    """One row per source: ``source, source_size, target``; weights repeat over the sources in code-point order.

    Water-filling with a sort: with the sources ordered by limit / weight, those before some place stand at their
    limit and the rest share what is left by weight; the place follows from running sums. One row per source meets
    in one task here, never the documents.
    """
    per = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, len(weights)) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("lim", F.col("source_size") * F.lit(float(max_copies)))
    by = Window.orderBy(F.col("lim") / F.col("w"), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    rest = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(1))
    per = (
        per.withColumn("total", F.sum("source_size").over(every).cast("double"))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("lim").over(before), F.lit(0.0)))
        .withColumn("share", F.col("left") / F.sum("w").over(rest))
        .withColumn("open", F.col("share") * F.col("w") <= F.col("lim"))
    )
    level = F.min(F.when(F.col("open"), F.struct(F.col("lim") / F.col("w"), F.col("share").alias("share")))).over(every)["share"]
    return per.withColumn("level", level).select(
        "source",
        "source_size",
        F.coalesce(F.least(F.col("level") * F.col("w"), F.col("lim")), F.col("lim")).alias("target"),
    )


def _uniform(seed: int, *parts: Column) -> Column:
    """A number in (0, 1) that depends on the seed and the parts alone."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def _fold(units: Column, seed: int) -> Column:
    """Pivotal rounding along an array of (u, k, p): struct(done: array of (u, k, up), rest: the open unit or null)."""
    typ = "array<struct<u:bigint,k:bigint,up:int>>"
    start = F.struct(
        F.array().cast(typ).alias("done"),
        F.lit(None).cast("bigint").alias("u"),
        F.lit(None).cast("bigint").alias("k"),
        F.lit(0.0).alias("p"),
    )

    def state(done, u, k, p):
        return F.struct(done.alias("done"), u.alias("u"), k.alias("k"), p.alias("p"))

    def settled(u, k, up):
        return F.array(F.struct(u.alias("u"), k.alias("k"), F.lit(up).alias("up")))

    def step(s: Column, x: Column) -> Column:
        def meet(v: Column) -> Column:  # v: the sum of both masses and the draw
            total, draw = v["t"], v["r"]
            small = total < 1.0
            keep_old = F.when(small, draw * total < s["p"]).otherwise(draw * (2.0 - total) < 1.0 - x["p"])
            # below 1: the loser drops to 0, the winner carries the sum; else: the winner is 1, the loser carries on
            done = F.when(small & keep_old, settled(x["u"], x["k"], 0)).when(small, settled(s["u"], s["k"], 0)).when(
                keep_old, settled(s["u"], s["k"], 1)).otherwise(settled(x["u"], x["k"], 1))
            old_stays = small == keep_old
            return state(
                F.concat(s["done"], done),
                F.when(old_stays, s["u"]).otherwise(x["u"]),
                F.when(old_stays, s["k"]).otherwise(x["k"]),
                F.when(small, total).otherwise(total - 1.0),
            )

        pair = F.struct((s["p"] + x["p"]).alias("t"), _uniform(seed, s["u"], s["k"], x["u"], x["k"]).alias("r"))
        alone = state(s["done"], x["u"], x["k"], x["p"])
        closed_old = F.when(s["p"] <= EPS, settled(s["u"], s["k"], 0)).otherwise(settled(s["u"], s["k"], 1))
        return (
            F.when(s["u"].isNull(), alone)
            .when((s["p"] <= EPS) | (s["p"] >= 1 - EPS), state(F.concat(s["done"], closed_old), x["u"], x["k"], x["p"]))
            .otherwise(let(pair, meet))
        )

    return F.aggregate(units, start, step)


def pivotal(units: DataFrame, seed: int = 17, bundle: int = 64) -> DataFrame:
    """Rounds masses to 0 or 1 so that each group's sum is kept to less than one unit.

    ``units``: ``g`` (group), ``cls`` (like units meet first), ``u, k`` (bigint: identity, unique in a group),
    ``p`` in [0, 1). Returns ``g, u, k, up``. ``bundle``: about how many units one fold takes.
    """
    parts, level = [], 0
    open_ = units.select("g", "cls", "u", "k", "p")
    while True:
        sizes = open_.groupBy("g", "cls").agg(F.count(F.lit(1)).alias("n"))
        at = sizes.agg(F.count(F.lit(1)), F.max("n"), F.sum("n")).first()
        if not at[2]:
            break
        last = at[1] <= bundle  # one bundle holds every class; then the classes of a group meet as well
        if last and not at[0]:
            break
        n_sub = F.ceil(F.col("n") / F.lit(bundle)).cast("long")
        s = sizes.select(F.col("g").alias("g_"), F.col("cls").alias("cls_"), n_sub.alias("n_sub"))
        placed = (
            open_.join(sized(s, at[0], 48), F.col("g").eqNullSafe(F.col("g_")) & F.col("cls").eqNullSafe(F.col("cls_")))
            .withColumn("b", F.pmod(F.xxhash64(F.lit(seed + 1000 + level), F.col("u"), F.col("k")), F.col("n_sub")))
            .groupBy("g", "cls", "b")
            .agg(F.array_sort(F.collect_list(F.struct("u", "k", "p"))).alias("units"))
        )
        folded = stored(placed.select("g", "cls", _fold(F.col("units"), seed + level).alias("s")), f"level{level}")
        parts.append(folded.select("g", F.explode("s.done").alias("d")).select("g", "d.u", "d.k", "d.up"))
        rest = folded.filter(F.col("s.u").isNotNull()).select("g", "cls", "s.u", "s.k", "s.p")
        level += 1
        if last:  # classes halve until one is left
            if folded.agg(F.max("cls")).first()[0] == 0:
                parts.append(
                    rest.select("g", "u", "k", (_uniform(seed - 1, F.col("u"), F.col("k")) < F.col("p")).cast("int").alias("up"))
                )
                break
            rest = rest.withColumn("cls", F.shiftright(F.col("cls"), 4))
        open_ = rest
    if not parts:
        return units.select("g", "u", "k", F.lit(0).alias("up"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mixed(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple = (5.0, 2.0, 1.0),
    max_copies: float = 3.0,
    seed: int = 17,
    bundle: int = 64,
) -> DataFrame:
    """One row per document: ``key, dup, size, source, source_size, target, copies``; the mix takes ``copies`` of it.

    ``dup`` numbers rows that share key, source and size (0 where keys are unique).
    """
    base = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    base = stored(base.groupBy("key", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "sizes")
    base = base.withColumn("dup", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1))).drop("rows")
    targets = stored(source_targets(base, weights, max_copies), "targets")
    n = targets.count()
    t = sized(targets.withColumnRenamed("source", "s_"), n, 64)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    full = base.join(t, F.col("source").eqNullSafe(F.col("s_"))).drop("s_").withColumn("rate", rate)
    full = full.withColumn("whole", F.floor(F.col("rate") + EPS)).withColumn(
        "p", F.greatest(F.lit(0.0), F.col("rate") - F.col("whole"))
    )
    # Size classes of 1/8 of a power of two: like lengths meet first.
    cls = F.floor(F.log2(F.greatest(F.col("size"), F.lit(1)).cast("double")) * 8).cast("int")
    whole_key = dict(base.dtypes)["key"] in ("bigint", "int", "smallint", "tinyint")
    # (u, k) tells rows of a source apart: the key itself or one hash of it, and another hash of all that can differ.
    full = full.withColumn("u", F.coalesce(F.col("key").cast("bigint"), F.lit(-1)) if whole_key else F.xxhash64("key"))
    full = full.withColumn("k", F.xxhash64(F.lit(3), F.col("key"), F.col("size"), F.col("dup")))
    units = full.filter((F.col("p") > EPS) & (F.col("size") > 0)).select(
        F.col("source").alias("g"), cls.alias("cls"), "u", "k", "p"
    )
    ups = (
        pivotal(units, seed, bundle)
        .filter("up = 1")
        .select(F.col("g").alias("g_"), F.col("u").alias("u_"), F.col("k").alias("k_"), "up")
    )
    on = F.col("source").eqNullSafe(F.col("g_")) & (F.col("u") == F.col("u_")) & (F.col("k") == F.col("k_"))
    return full.join(ups, on, "left").select(
        "key",
        "dup",
        "size",
        "source",
        "source_size",
        "target",
        F.when(F.col("size") > 0, F.col("whole") + F.coalesce(F.col("up"), F.lit(0))).otherwise(0).cast("long").alias("copies"),
    )


def mix(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """``docs`` as the mix takes them: every row as often as its copies say."""
    m = stored(mixed(docs, key=key, text=text, source=source, **options), "mixed")
    rows, most = m.agg(F.count(F.lit(1)), F.max("dup")).first()
    m = m.filter("copies > 0").select(F.col("key").alias("__k"), F.col("source").alias("__s"), F.col("size").alias("__n"), F.col("dup").alias("__i"), F.col("copies").alias("__c"))
    named = docs.withColumn("__size", n_words(F.col(text)))
    on = F.col(key).eqNullSafe(F.col("__k")) & F.col(source).eqNullSafe(F.col("__s")) & (F.col("__size") == F.col("__n"))
    if most:  # rows that share key, source and size take the copies in the order of their texts
        named = named.withColumn("__dup", F.row_number().over(Window.partitionBy(key, source, "__size").orderBy(text)) - 1)
        on = on & (F.col("__dup") == F.col("__i"))
    joined = named.join(sized(m, rows, 64), on)
    return joined.select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("__c"))).alias("__x")).select(*docs.columns)


def op10_mix(spark, sf_dir: str) -> DataFrame:
    """Query: each document's share in the mix."""
    m = mixed(table(spark, sf_dir, "documents"))
    return m.select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )
