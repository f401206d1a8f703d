"""A footer cell that must hold every entry of an ordered ledger: validation, the first arrangement that fits, audit.

A ledger has three ordered arrays: linear and angular entries (a tier and a value each) and conditions (a text each).
Their numbers are free, tiers and whole entries may repeat, and nothing is dropped, merged or reworded. All of it is
column expressions over one ledger a row: ledgers never meet, so any number of them costs one pass without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions import text as T

# The ledger's arrays, the heading and its sizes, the font ladder, the cell's measures in points.
ARRAYS = ("linear_tolerances", "angular_tolerances", "additional_tolerance_conditions")
HEADING = (("UNLESS OTHERWISE", 6.0), ("SPECIFIED, TOLERANCE:", 5.6))
SIZES = (7.0, 6.5, 6.0, 5.5, 5.0, 4.75)
PAD, GAP, LEAST_HEIGHT, BODY_TOP = 4.0, 4.0, 38.0, 23.0
# Advance widths of Helvetica in thousandths of the font size, as published in its font metrics.
ADVANCES = {
    222: "ijl", 260: "|", 278: " !,./:;I[\\]ft", 191: "'", 333: "()-`r", 334: "{}", 355: '"', 389: "*", 400: "°", 469: "^",
    500: "Jckvsxyz", 556: "#$0123456789?L_abdeghnopqu", 584: "+<=>~±", 611: "FTZ", 667: "&ABEKPSVXY", 722: "CDHNRUw", 778: "GOQ",
    833: "Mm", 889: "%", 944: "W", 1015: "@",
}
PAIR = "struct<tier:string,value:string>"


def advances(table: dict[int, str] = ADVANCES) -> Column:
    """A map from character to advance width."""
    return F.create_map(*[x for w, cs in sorted(table.items()) for c in cs for x in (F.lit(c), F.lit(w / 1000))])


def line_width(line: Column, widths: Column) -> Column:
    """Width at size 1; null if the font lacks a character."""
    return F.aggregate(F.split(line, ""), F.lit(0.0), lambda s, c: F.when(c == "", s).otherwise(s + F.element_at(widths, c)))


def parsed(df: DataFrame, ledger: str) -> DataFrame:
    """Adds ``linear, angular`` (arrays of tier and value), ``conditions`` (texts) and ``faults`` of a JSON ledger.

    Faults: ``not an object``, ``unknown NAME``, ``missing NAME`` (absent, or no array), ``entry NAME`` (an entry of
    another form), ``text NAME`` (empty text, outer blanks, control characters), ``empty``. With a fault the arrays hold
    what could be read. A null ledger is no object.
    """
    v = F.try_parse_json(F.col(ledger))
    named = F.try_variant_get(v, "$", "map<string,variant>")
    entries = {a: F.try_variant_get(v, f"$.{a}", "array<variant>") for a in ARRAYS}
    out = df.withColumns({"__m": named, **{f"__{a}": e for a, e in entries.items()}})
    faults = [F.when(F.col("__m").isNull(), F.array(F.lit("not an object"))).otherwise(
        F.transform(F.array_sort(F.array_except(F.map_keys("__m"), F.array(*map(F.lit, ARRAYS)))), lambda k: F.concat(F.lit("unknown "), k)))]
    read = []
    for a in ARRAYS:
        pair = a != ARRAYS[2]
        e = F.coalesce(F.col(f"__{a}"), F.array().cast("array<variant>"))
        keys = lambda x: F.array_sort(F.map_keys(F.try_variant_get(x, "$", "map<string,variant>")))
        isa = lambda x, path="$": F.schema_of_variant(F.try_variant_get(x, path, "variant")) == "STRING"
        if pair:
            good = lambda x: F.coalesce((keys(x) == F.array(F.lit("tier"), F.lit("value"))) & isa(x, "$.tier") & isa(x, "$.value"), F.lit(False))
            get = lambda x: F.struct(F.try_variant_get(x, "$.tier", "string").alias("tier"), F.try_variant_get(x, "$.value", "string").alias("value"))
            sane = lambda x: T.clean(x["tier"]) & T.clean(x["value"])
        else:
            good = lambda x: F.coalesce(isa(x) | ((keys(x) == F.array(F.lit("text"))) & isa(x, "$.text")), F.lit(False))
            get = lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")).otherwise(F.try_variant_get(x, "$.text", "string"))
            sane = T.clean
        rows = F.transform(F.filter(e, good), get)
        read.append(rows)
        faults += [
            F.when(F.col("__m").isNotNull() & F.col(f"__{a}").isNull(), F.array(F.lit(f"missing {a}"))),
            F.when(F.exists(e, lambda x: ~good(x)), F.array(F.lit(f"entry {a}"))),
            F.when(F.exists(rows, lambda x: ~sane(x)), F.array(F.lit(f"text {a}"))),
        ]
    none = F.array().cast("array<string>")
    found = F.flatten(F.array(*[F.coalesce(f, none) for f in faults]))
    out = out.withColumns({"linear": read[0], "angular": read[1], "conditions": read[2], "faults": found})
    empty = F.when((F.size("faults") == 0) & (F.size("linear") + F.size("angular") + F.size("conditions") == 0), F.array(F.lit("empty"))).otherwise(none)
    return out.withColumn("faults", F.concat("faults", empty)).drop("__m", *[f"__{a}" for a in ARRAYS])


def arranged(df: DataFrame, box: tuple[str, str, str, str] = ("x0", "y0", "x1", "y1"), widths: dict[int, str] = ADVANCES, sizes: tuple[float, ...] = SIZES) -> DataFrame:
    """Adds ``fault, mode, size, step, items``: the first arrangement of a ledger's entries that fits its cell.

    ``df`` has ``linear, angular, conditions`` as ``parsed`` gives them, and a cell. Arrangements in order: a column for
    each of both kinds, if both occur; else one column, then two columns in reading order. Within each, font sizes from
    the largest. ``items`` (``kind, text, x, y``, baselines) keep order and repeats; conditions stand below, over the
    whole width. ``fault`` is the first of ``box``, ``glyph``, ``heading``, ``overflow``, and then nothing is placed.
    """
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in box)
    w = advances(widths)
    lines = lambda c, kind: F.transform(F.col(c), lambda e: F.struct(F.lit(kind).alias("kind"), T.tier_line(e["tier"], e["value"]).alias("text")))
    out = df.withColumns({"__l": lines("linear", "linear"), "__a": lines("angular", "angular")})
    out = out.withColumn("__c", F.transform("conditions", lambda t: F.struct(F.lit("condition").alias("kind"), t.alias("text"))))
    widest = lambda entries: F.aggregate(entries, F.lit(0.0), lambda m, e: F.greatest(m, line_width(e["text"], w)))
    lacks = lambda entries: F.exists(entries, lambda e: line_width(e["text"], w).isNull())
    out = out.withColumns(
        {
            "__usable": x1 - x0 - 2 * PAD,
            "__wide": widest(F.concat("__l", "__a")),
            "__wide_c": widest(F.col("__c")),
            "__glyph": lacks(F.col("__l")) | lacks(F.col("__a")) | lacks(F.col("__c")),
        }
    )
    both, single = (F.size("__l") > 0) & (F.size("__a") > 0), F.concat("__l", "__a")
    n, half = F.size("__l") + F.size("__a"), F.ceil((F.size("__l") + F.size("__a")) / 2).cast("int")
    mode = lambda name, left, right: F.struct(F.lit(name).alias("mode"), left.cast("int").alias("left"), right.cast("int").alias("right"))
    modes = F.when(both, F.array(mode("category_columns", F.size("__l"), F.size("__a")))).otherwise(
        F.concat(F.array(mode("single_column", n, F.lit(0))), F.when(n > 1, F.array(mode("flow_columns", half, n - half))).otherwise(F.array().cast("array<struct<mode:string,left:int,right:int>>")))
    )
    ladder = F.array(*[F.lit(float(s)) for s in sizes])
    tries = F.flatten(F.transform(modes, lambda m: F.transform(ladder, lambda s: F.struct(m["mode"].alias("mode"), m["left"].alias("left"), m["right"].alias("right"), s.alias("size"), F.greatest(s * 1.4, s + 1.5).alias("step")))))
    column = lambda t: F.when(t["right"] > 0, (F.col("__usable") - GAP) / 2).otherwise(F.col("__usable"))
    rows = lambda t: F.greatest(t["left"], t["right"])

    def fits(t: Column) -> Column:
        down = y0 + BODY_TOP + t["size"] + (rows(t) + F.size("__c") - 1) * t["step"] <= y1 - PAD
        return (column(t) > 0) & down & (F.col("__wide") * t["size"] <= column(t)) & (F.col("__wide_c") * t["size"] <= F.col("__usable"))

    best = F.get(F.filter(tries, fits), 0)
    finite = [~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))) for v in (x0, y0, x1, y1)]
    bad_box = ~F.coalesce(finite[0] & finite[1] & finite[2] & finite[3] & (x1 > x0) & (y1 > y0), F.lit(False))
    head = max(sum(k for c in line for k, cs in ((k / 1000, cs) for k, cs in widths.items()) if c in cs) * s for line, s in HEADING)
    out = out.withColumn("__best", best)
    fault = F.when(bad_box, "box").when(F.col("__glyph"), "glyph").when((y1 - y0 < LEAST_HEIGHT) | (F.col("__usable") < head), "heading").when(F.col("__best").isNull(), "overflow")
    t = F.col("__best")
    body = y0 + BODY_TOP + t["size"]
    item = lambda e, x, y: F.struct(e["kind"].alias("kind"), e["text"].alias("text"), x.alias("x"), y.alias("y"))
    entries = F.transform(single, lambda e, i: item(e, x0 + PAD + F.when(i < t["left"], 0.0).otherwise(column(t) + GAP), body + F.when(i < t["left"], i).otherwise(i - t["left"]) * t["step"]))
    below = F.transform("__c", lambda e, i: item(e, x0 + PAD, body + (rows(t) + i) * t["step"]))
    out = out.withColumn("fault", fault)
    good = F.col("fault").isNull()
    out = out.withColumns({"mode": F.when(good, t["mode"]), "size": F.when(good, t["size"]), "step": F.when(good, t["step"]), "items": F.when(good, F.concat(entries, below))})
    return out.drop("__l", "__a", "__c", "__usable", "__wide", "__wide_c", "__glyph", "__best")


def heading_items(box: tuple[str, str, str, str] = ("x0", "y0", "x1", "y1")) -> Column:
    """The two fixed lines as items with their sizes."""
    x0, y0 = F.col(box[0]).cast("double"), F.col(box[1]).cast("double")
    return F.array(*[F.struct(F.lit(t).alias("text"), (x0 + PAD).alias("x"), (y0 + 10.0 + 8.0 * i).alias("y"), F.lit(s).alias("size")) for i, (t, s) in enumerate(HEADING)])


def audited(df: DataFrame, expected: str, actual: str) -> DataFrame:
    """Adds ``missing`` (expected lines whose count differs), ``unexpected`` and ``passed``; both columns are arrays of lines.

    Lines are compared as bags, so a line planned twice must be there twice.
    """
    times = lambda a, x: F.size(F.filter(a, lambda y: y == x))
    e, a = F.coalesce(F.col(expected), F.array().cast("array<string>")), F.coalesce(F.col(actual), F.array().cast("array<string>"))
    out = df.withColumns({"__e": e, "__a": a})
    missing = F.filter(F.array_sort(F.array_distinct("__e")), lambda x: times(F.col("__e"), x) != times(F.col("__a"), x))
    out = out.withColumns({"missing": missing, "unexpected": F.array_sort(F.array_except("__a", "__e"))})
    return out.withColumn("passed", (F.size("missing") == 0) & (F.size("unexpected") == 0) & (F.size("__e") == F.size("__a"))).drop("__e", "__a")
