"""Op 4: document fingerprints by invertible Bloom lookup sketches of paragraph digests.

One rule cuts every text into pieces that cover it whole: its first ``HEAD`` code points into words, the rest behind
stops, line breaks and words that end in one of a fixed class of characters, or else after ``LONGEST`` code points. A piece's
digest holds its length; the second and further occurrences of a piece in a text have digests of their own. A sketch
has three subtables of a power of two cells; each digest adds 1 to the count and itself and a check hash to the sums
(exclusive or) of one cell in each. The number of cells follows from the text's own number of pieces, so equal texts
have equal fingerprints. The printed fingerprint is that sketch whole: code points, cells of a subtable, and every
filled cell with count, sum and check sum, so two prints can be compared without their texts.

Likeness of two fingerprints: the smaller sketch is brought to the larger one's cells (it lists its own digests, since
it has 1.5 cells a subtable and digest at least), subtracted, and peeled: a cell with a count of 1 or -1 and a
matching check holds one differing digest, and taking it out of its other cells frees more. When every cell is empty
the differing digests are all recovered; with the lengths they hold they give the weighted Jaccard likeness, the
share of code points in common pieces. Sketches that do not empty are built again with other hashes, twice as large.

Plan, in SQL functions alone. The texts are shuffled once, to their key, and meet there what the next document sends:
the few code points that the edit needs, and its digests. Building, subtracting and peeling group by (document, pair,
cell), for which that partitioning serves, so no cell is shuffled. A round of peeling takes the pure cells of one
subtable only, so a digest is taken out once. Only the documents whose sketches did not empty are read for a retry.
The prints come from a second pass over the texts instead of a stored copy of all digests.

Defined results. Null text: empty, no pieces; two empty sketches have likeness 1. Rows equal in key and text give as
many equal rows. Among rows with one key, texts follow in descending order of a hash. Null keys come last in
descending order. A single document is its own next. Very long texts are cut and compared whole. An empty table gives
an empty result. Other columns, whatever their names, are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import let, sized, stored, table, tidy

#: The code points that are cut into words.
HEAD = 64
WORDS = r"\S{1,16}\s{0,16}|\s{1,16}"
#: A word that ends in one of these ends a piece, as do stops and line breaks; a piece has at most ``LONGEST`` code points.
LAST = "".join(rf"\x{c:02x}" for c in range(0x21, 0x100) if c % 11 == 3 and not chr(c).isspace())
CUT = rf"(?<=[.?;:7{LAST}][\x20\n])|(?<=\n)"
LONGEST = 192
#: Rounds of peeling a try, and tries before the rest is counted exactly.
ROUNDS, TRIES = 9, 6
#: Cells of a subtable at least.
LEAST = 1024
_LENGTH = 511


def pieces(text: Column) -> Column:
    """Digests of all pieces, repeats included: a hash, the lowest nine bits the number of code points."""
    rest = let(F.split(F.substring(text, HEAD + 1, (1 << 31) - 1 - HEAD), CUT, -1), _short)
    cut = F.concat(F.regexp_extract_all(F.substring(text, 1, HEAD), F.lit(WORDS), F.lit(0)), F.when(F.length(text) > HEAD, rest).otherwise(F.array().cast("array<string>")))
    return F.transform(F.filter(cut, lambda x: x != ""), lambda x: F.xxhash64(x).bitwiseAND(F.lit(~_LENGTH)).bitwiseOR(F.length(x)))


def _short(parts: Column) -> Column:
    """Pieces longer than ``LONGEST`` as several."""
    blocks = F.flatten(F.transform(parts, lambda x: F.when(F.length(x) > LONGEST, F.regexp_extract_all(x, F.lit(rf"[\s\S]{{1,{LONGEST}}}"), F.lit(0))).otherwise(F.array(x))))
    return F.when(F.exists(parts, lambda x: F.length(x) > LONGEST), blocks).otherwise(parts)


def _bits(n: Column, least: int, scale: int = 0) -> Column:
    """Binary logarithm of the cells in a subtable for a text of n pieces."""
    return (F.ceil(F.log2(F.greatest(F.lit(float(least)), n * 1.5))) + scale).cast("int")


def _cell(x: Column | str, j: Column | str, bits: Column | str) -> Column:
    """The cell of a digest in the subtable that ``j`` leaves modulo 3."""
    return F.xxhash64(j, x).bitwiseAND(F.expr(f"shiftleft(1L, {bits})") - 1) * 3 + F.pmod(j, F.lit(3))


def _check(x: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit("check"), x), 32)


def _numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., x`` with x a digest of its own for each occurrence of a digest ``d``."""
    counted = rows.groupBy(*keys, "d").agg(F.count(F.lit(1)).alias("c"))
    each = counted.select(*keys, "d", F.explode(F.sequence(F.lit(1).cast("long"), F.col("c"))).alias("i"))
    own = F.xxhash64("d", "i").bitwiseAND(F.lit(~_LENGTH)).bitwiseOR(F.col("d").bitwiseAND(F.lit(_LENGTH)))
    return each.select(*keys, own.alias("x"))


def _sum(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys, "cell").agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check"))


def _full() -> Column:
    return (F.col("n") != 0) | (F.col("key") != 0) | (F.col("check") != 0)


def _put(rows: DataFrame, keys: list[str], salt: int, sign: Column | None = None) -> DataFrame:
    """Sketch cells of ``keys..., bits, x``; small steps, so that each compiles well."""
    three = rows.withColumn("j", F.explode(F.array(*[F.lit(salt * 3 + j) for j in range(3)])))
    cells = three.select(*keys, _cell("x", F.col("j"), "bits").alias("cell"), (F.lit(1) if sign is None else sign).cast("long").alias("n"), F.col("x").alias("key"), _check(F.col("x")).alias("check"))
    return _sum(cells, keys)


def peel(cells: DataFrame, keys: list[str], salt: int, rounds: int = ROUNDS) -> DataFrame:
    """``keys..., only_a, only_b, open`` from subtracted cells: code points of the digests recovered on each side, cells left.

    A digest that is taken out goes to its two other cells and, as code points, to the cell -1 or -2 of its side.
    """
    keys = [*keys, "bits"]
    state = cells.filter(_full()).select(*keys, "cell", "n", "key", "check")
    zero = F.lit(0).cast("long")
    for r in range(rounds):
        j = r % 3
        pure = (F.col("cell") >= 0) & (F.pmod(F.col("cell"), F.lit(3)) == j) & (F.abs("n") == 1) & (F.col("check") == _check(F.col("key")))
        to = F.when(pure, F.array(*[F.lit(salt * 3 + k) for k in range(3) if k != j], F.lit(-1))).otherwise(F.array(F.lit(-2)))
        moved = state.withColumn("to", F.explode(to))
        stays, out = F.col("to") == -2, F.col("to") >= 0
        state = moved.select(
            *keys,
            F.when(stays, F.col("cell")).when(out, _cell("key", F.col("to"), "bits")).otherwise(F.when(F.col("n") == 1, F.lit(-1)).otherwise(F.lit(-2)).cast("long")).alias("cell"),
            F.when(stays, F.col("n")).when(out, -F.col("n")).otherwise(F.col("key").bitwiseAND(F.lit(_LENGTH))).alias("n"),
            F.when(stays | out, F.col("key")).otherwise(zero).alias("key"),
            F.when(stays | out, F.col("check")).otherwise(zero).alias("check"),
        )
        state = _sum(state, keys).filter(_full())
    total = lambda which: F.sum(F.when(F.col("cell") == which, F.col("n")).otherwise(0))
    return state.groupBy(*keys).agg(total(-1).alias("only_a"), total(-2).alias("only_b"), F.sum((F.col("cell") >= 0).cast("long")).alias("open")).drop("bits")


def _pairs() -> Column:
    """The pairs that a side takes part in: 0 with the edited text, 1 with the next one."""
    return F.explode(F.when(F.col("side") == 0, F.array(F.lit(0), F.lit(1))).when(F.col("side") == 1, F.array(F.lit(0))).otherwise(F.array(F.lit(1))))


def differing(rows: DataFrame, keys: list[str], salt: int) -> DataFrame:
    """What :func:`peel` recovers of both pairs, from ``keys..., side, b0, b1, x``: side 0 is compared with 1 and 2."""
    both = rows.withColumn("pair", _pairs()).select(*keys, "pair", F.when(F.col("pair") == 0, F.col("b0")).otherwise(F.col("b1")).alias("bits"), "side", "x")
    return peel(_put(both, [*keys, "pair", "bits"], salt, F.when(F.col("side") == 0, 1).otherwise(-1)), [*keys, "pair"], salt)


def exactly_differing(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The same, without a sketch."""
    net = rows.select(*keys, "x", F.when(F.col("side") == 0, 1).otherwise(-1).alias("s"), _pairs().alias("pair")).groupBy(*keys, "pair", "x").agg(F.sum("s").alias("s"))
    chars = F.col("x").bitwiseAND(F.lit(_LENGTH))
    return net.groupBy(*keys, "pair").agg(F.sum(F.when(F.col("s") > 0, chars).otherwise(0)).alias("only_a"), F.sum(F.when(F.col("s") < 0, chars).otherwise(0)).alias("only_b"), F.lit(0).cast("long").alias("open"))


#: Stands for a null key, which comes last in descending order.
NO_KEY = -(1 << 63)


def next_rows(rows: DataFrame, parts: int) -> DataFrame:
    """``rows`` (``k, h`` and more) with the next row's ``nk, nh``: descending (k, h), after the last the first.

    Rows are ordered by ranges; inside a range by a window, and one row a range links the ranges.
    """
    order = [F.col("k").desc(), F.col("h").desc()]
    ranged = stored(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranges")
    edge = ranged.groupBy("part").agg(F.max(F.struct("k", "h")).alias("top"))
    by_part = Window.orderBy("part")  # one row a range
    edge = edge.select("part", F.coalesce(F.lead("top").over(by_part), F.first("top").over(by_part.rowsBetween(Window.unboundedPreceding, 0))).alias("after"))
    w = Window.partitionBy("part").orderBy(*order)
    inner = ranged.withColumn("in", F.lead(F.struct("k", "h")).over(w))
    nxt = F.coalesce("in", "after")
    return inner.join(F.broadcast(edge), "part").select(*rows.columns, nxt["k"].alias("nk"), nxt["h"].alias("nh"))


def _met(one: DataFrame, ids: DataFrame, n_ids: int, parts: int, digests: bool) -> DataFrame:
    """``k, h, t, e`` and, if asked, the next text's digests ``nd``: both sides shuffled to the document's (k, h)."""
    asked = sized(ids.select(F.col("nk").alias("k"), F.col("nh").alias("h"), F.col("k").alias("to_k"), F.col("h").alias("to_h"), (F.col("n") / 3).cast("int").alias("third")), n_ids, 64)
    message = one.join(asked, ["k", "h"]).select(F.col("to_k").alias("k"), F.col("to_h").alias("h"), F.expr("substring(t, 1, third)").alias("head"), *([pieces(F.col("t")).alias("nd")] if digests else []))
    full = one.repartition(parts, "k", "h").join(message.repartition(parts, "k", "h"), ["k", "h"])
    return full.withColumn("e", F.concat(F.expr("substring(t, 1, length(t) - cast(length(t) div 3 as int))"), "head"))


def _compared(full: DataFrame, least: int, scale: int) -> DataFrame:
    """``k, h, side, b0, b1, x`` of the text (0), its edited text (1) and the next one (2)."""
    a = full.select("k", "h", pieces(F.col("t")).alias("a"), pieces(F.col("e")).alias("b"), "nd")
    size = lambda *c: _bits(F.greatest(*map(F.size, c)), least, scale)
    side = lambda c, s: F.transform(c, lambda x: F.struct(F.lit(s).alias("side"), x.alias("d")))
    flat = a.select("k", "h", size("a", "b").alias("b0"), size("a", "nd").alias("b1"), F.inline(F.concat(side("a", 0), side("b", 1), side("nd", 2))))
    return _numbered(flat, ["k", "h", "side", "b0", "b1"])


def _printed(full: DataFrame, least: int) -> DataFrame:
    """``k, h, fingerprint, edited_fingerprint, edited_sha256``.

    Besides pieces (sides 0 and 1) a document's rows hold its code points, sizes and digest (sides from 2 on).
    """
    a = full.select("k", "h", "t", "e", F.sha2("e", 256).alias("sha"), pieces(F.col("t")).alias("a"), pieces(F.col("e")).alias("b"))
    head = lambda s, x: F.struct(F.lit(s).alias("side"), F.lit(0).alias("bits"), x.cast("long").alias("d"))
    side = lambda c, s: F.transform(c, lambda x: F.struct(F.lit(s).alias("side"), _bits(F.size(c), least).alias("bits"), x.alias("d")))
    heads = [F.length("t"), F.length("e"), _bits(F.size("a"), least), _bits(F.size("b"), least), *[F.conv(F.substring("sha", 13 * i + 1, 13), 16, 10) for i in range(5)]]
    flat = a.select("k", "h", F.inline(F.concat(side("a", 0), side("b", 1), F.array(*[head(i + 2, x) for i, x in enumerate(heads)]))))
    # a head's row goes through as one cell, numbers of pieces as three
    each = _numbered(flat.withColumn("head", F.when(F.col("side") > 1, F.col("d")).otherwise(0)), ["k", "h", "side", "bits", "head"])
    three = each.withColumn("j", F.explode(F.when(F.col("side") > 1, F.array(F.lit(-1))).otherwise(F.array(*[F.lit(j) for j in range(3)]))))
    piece, zero = F.col("j") >= 0, F.lit(0).cast("long")
    cells = three.select(
        "k", "h", "side", F.when(piece, _cell("x", F.col("j"), "bits")).otherwise(zero).alias("cell"), piece.cast("long").alias("n"),
        F.when(piece, F.col("x")).otherwise(F.col("head")).alias("key"), F.when(piece, _check(F.col("x"))).otherwise(zero).alias("check"),
    )
    summed = _sum(cells, ["k", "h", "side"])
    text = F.concat_ws(".", F.lpad(F.hex("cell"), 7, "0"), F.col("n").cast("string"), F.hex("key"), F.hex("check"))
    of = lambda s: F.max(F.when(F.col("side") == s, F.col("key")))
    listed = lambda s: F.collect_list(F.when(F.col("side") == s, text))
    got = summed.groupBy("k", "h").agg(listed(0).alias("c0"), listed(1).alias("c1"), *[of(i + 2).alias(f"h{i}") for i in range(len(heads))])
    fp = lambda s: F.concat_ws("|", F.col(f"h{s}").cast("string"), F.expr(f"shiftleft(1L, cast(h{s + 2} as int))").cast("string"), F.array_join(F.sort_array(f"c{s}"), ","))
    sha = F.concat(*[F.lpad(F.lower(F.hex(f"h{i + 4}")), 13 if i < 4 else 12, "0") for i in range(5)])
    return got.select("k", "h", fp(0).alias("fingerprint"), fp(1).alias("edited_fingerprint"), sha.alias("edited_sha256"))


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """Per row of ``docs``: ``key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has its last third of code points replaced by the first as many of the next document.
    """
    spark = docs.sparkSession
    tidy(spark)
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("k"), F.xxhash64(t).alias("h"), t.alias("t"))
    rows = base.select("k", "h", F.length("t").cast("long").alias("n")).groupBy("k", "h").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    rows = stored(rows, "rows")
    count, chars, most = rows.agg(F.count(F.lit(1)), F.sum("n"), F.max("copies")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int((chars or 0) >> 21))
    ids = stored(next_rows(rows, max(1, min(parts, (count >> 14) + 1))), "ids")
    one = base.dropDuplicates(["k", "h"]) if (most or 1) > 1 else base
    found, left, texts, n_left = [], ids, one, count
    for attempt in range(TRIES + 1):
        compared = _compared(_met(texts, left, n_left, min(parts, n_left + 1), True), least, attempt)
        tried = stored(differing(compared, ["k", "h"], attempt) if attempt < TRIES else exactly_differing(compared, ["k", "h"]), f"peeled{attempt}")
        found.append(tried.filter("open = 0"))
        left = stored(ids.join(tried.filter("open > 0").select("k", "h").distinct(), ["k", "h"], "left_semi"), "left")
        n_left = left.count()
        if not n_left:
            break
        # only these documents and the next of each are read again
        some = left.select("k", "h").unionByName(left.select(F.col("nk").alias("k"), F.col("nh").alias("h"))).distinct()
        texts = one.join(sized(some, 2 * n_left, 32), ["k", "h"], "left_semi")
    near = found[0]
    for f in found[1:]:
        near = near.unionByName(f)
    # a document tried again for one pair has the other one twice, with equal values
    part = lambda c, p: F.max(F.when(F.col("pair") == p, F.col(c))).alias(f"{c}{p}")
    flat = near.groupBy("k", "h").agg(*[part(c, p) for p in (0, 1) for c in ("only_a", "only_b")])

    def score(p: int) -> Column:
        only_a, only_b = (F.coalesce(F.col(f"{c}{p}"), F.lit(0)) for c in ("only_a", "only_b"))
        return F.when(F.col("n") + only_b == 0, 1.0).otherwise((F.col("n") - only_a) / (F.col("n") + only_b))

    scored = ids.join(flat, ["k", "h"], "left").select("k", "h", "n", "copies", score(0).alias("near_edited"), score(1).alias("near_next"))
    scored = stored(scored, "scored")
    out = _printed(_met(one, ids, count, parts, False), least).join(sized(scored, count, 64), ["k", "h"])
    return out.select(
        F.when(F.col("k") != NO_KEY, F.col("k")).alias("key"), F.col("n").alias("n_chars"), "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).drop("copy")


def op4_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Query: every document's fingerprint, that of its edited text, and what they have in common."""
    return fingerprints(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")
