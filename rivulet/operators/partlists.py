"""Part lists caught in a title-block region: a lattice of columns that persist over rows of one height, and the cut.

A list is a run of equally spaced row rules that columns run through. Where the rules of a run do not reach across all
columns, the run holds several lists side by side: the x-ranges common to all its rules (a sweep over the rules' spans)
part the columns into groups, each group goes on above and below on rules of its own, and the one that reads most like a
part list is it. Regions are then cut so that they end beside or below the lists.

Plan. Rules and words meet regions in equi-joins on the page; the sweep is one window per run. What is decided in order
(runs, growth, cuts) are folds over the arrays of one region, which hold the rules and words of one page: bounded by a
drawing, whatever the number of pages.

Inputs: ``rules`` (keys, orient, coord, lo, hi), ``words`` (keys, pos, x0, y0, x1, y1, text), ``marks`` (keys, x0, y0, x1,
y1: strokes that may be outlined text), ``regions`` (keys, region_id, x0, y0, x1, y1), ``frames`` (keys, x0, y0, x1, y1).
Null coordinates match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions import geometry as G
from rivulet.operators import graph, intervals
from rivulet.operators.joins import shuffled

# Words of a list's header, words of part lists and of revision tables.
HEADS = ("QTY", "Q'TY", "数量", "用量", "序号")
PARTS = ("QTY", "Q'TY", "数量", "用量", "MATERIAL", "材料", "材质", "PART", "零件", "部件", "料号", "品名", "ITEM", "序号")
REVISIONS = ("REV", "版本", "版次", "修订", "变更", "更改", "ECN", "ECO")
TOL = 1.5
ITEM = r"^(\d{1,3}|[A-Z])$"


def row_spans(rules: DataFrame, keys: list[str], tol: float = TOL) -> DataFrame:
    """``keys..., y, lo, hi``: what the horizontal rules of each height cover; double rules are one, gaps to ``tol`` close."""
    h = rules.filter((F.col("orient") == "H") & (F.col("hi") - F.col("lo") > tol))
    near = F.explode(F.array(*[F.floor(F.col("coord") / (2 * tol)) + d for d in (-1, 0, 1)])).alias("bin")
    heights = intervals.collapse_close(h, keys, "coord", tol).select(*keys, F.col("coord").alias("y"), F.floor(F.col("coord") / (2 * tol)).alias("bin"))
    met = h.select(*keys, "coord", "lo", "hi", near).join(shuffled(heights), [*keys, "bin"]).filter(F.abs(F.col("coord") - F.col("y")) <= tol)
    return intervals.runs(met, [*keys, "y"], tol).select(*keys, "y", "lo", "hi")


def column_spans(rules: DataFrame, keys: list[str], tol: float = TOL, bin_size: float = 0.6) -> DataFrame:
    """``keys..., x, lo, hi``: what the vertical rules of each place cover, gaps to ``tol`` closed."""
    v = rules.filter("orient = 'V'").withColumn("bin", F.rint(F.col("coord") / bin_size).cast("long"))
    x = F.avg("coord").over(Window.partitionBy(*keys, "bin"))
    return intervals.runs(v.withColumn("x", x), [*keys, "x"], tol).select(*keys, "x", "lo", "hi")


def _near(a: Column, b: Column, g: Column) -> Column:
    return F.abs(b - a - g) <= F.greatest(F.lit(0.8), 0.12 * g)


def row_run(ys: Column, i: Column) -> Column:
    """Row rules of equal height from the i-th on (from 0); one stray rule may split a row."""
    first = F.struct(F.slice(ys, i + 1, 2).alias("rows"), F.lit(None).cast("double").alias("stray"), F.lit(False).alias("done"))
    g = F.get(ys, i + 1) - F.get(ys, i)

    def step(s: Column, y: Column) -> Column:
        more = _near(F.element_at(s["rows"], -1), y, g)
        return F.when(s["done"], s).otherwise(
            F.struct(
                F.when(more, F.concat(s["rows"], F.array(y))).otherwise(s["rows"]).alias("rows"),
                F.when(more, F.lit(None).cast("double")).otherwise(y).alias("stray"),
                (~more & s["stray"].isNotNull()).alias("done"),
            )
        )

    return F.aggregate(F.slice(ys, i + 3, F.size(ys)), first, step, lambda s: s["rows"])


def _through(v: Column, a: Column, b: Column, tol: float) -> Column:
    """Whether a vertical span runs through the band, short of it by ``tol`` at most in all."""
    return F.greatest(v["lo"] - a, F.lit(0.0)) + F.greatest(b - v["hi"], F.lit(0.0)) <= tol


def _columns(vs: Column, a: Column, b: Column, tol: float) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.filter(vs, lambda v: _through(v, a, b, tol)), lambda v: v["x"])))


def _same_box(vs: Column, a: Column, b: Column, cols: Column, tol: float) -> Column:
    """Whether the lattice's columns run through the band: both outer ones, and two inner ones or all."""
    here = lambda x: F.exists(vs, lambda v: _through(v, a, b, tol) & (F.abs(v["x"] - x) < tol))
    inner = F.slice(cols, 2, F.size(cols) - 2)
    return here(F.get(cols, 0)) & here(F.element_at(cols, -1)) & (F.size(F.filter(inner, here)) >= F.least(F.lit(2), F.size(inner)))


def _same_inner(vs: Column, a: Column, b: Column, cols: Column, tol: float) -> Column:
    here = lambda x: F.exists(vs, lambda v: _through(v, a, b, tol) & (F.abs(v["x"] - x) < tol))
    inner = F.slice(cols, 2, F.size(cols) - 2)
    return F.size(F.filter(inner, here)) >= F.least(F.lit(2), F.size(inner))


def _text(ws: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Upper case and without blanks: the words whose centre lies in the rectangle."""
    inside = F.filter(ws, lambda w: (w["x"] >= x0) & (w["x"] <= x1) & (w["y"] >= y0) & (w["y"] <= y1))
    return F.upper(F.replace(F.array_join(F.transform(inside, lambda w: w["t"]), ""), F.lit(" "), F.lit("")))


def _has(text: Column, words: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(text, w))


def _bands(rows: Column) -> Column:
    """Neighbouring row rules as (a, b)."""
    return F.transform(F.slice(rows, 1, F.size(rows) - 1), lambda a, i: F.struct(a.alias("a"), F.get(rows, i + 1).alias("b")))


def _items(ws: Column, rows: Column, cols: Column) -> Column:
    """Whether item numbers stand in two rows of the first column."""
    return F.size(F.filter(_bands(rows), lambda r: _text(ws, F.get(cols, 0), r["a"], F.get(cols, 1), r["b"]).rlike(ITEM))) >= 2


def lattices(rules: DataFrame, regions: DataFrame, frames: DataFrame, keys: list[str], tol: float = TOL) -> tuple[DataFrame, DataFrame]:
    """(runs, groups). A run: ``keys..., region_id, start, rows, cols, pitch`` with all row heights ``ys`` and the region's
    verticals ``vs``; runs do not overlap but at their ends. A group: ``keys..., region_id, start, lo, hi, cols``, four
    columns or more between which all row rules of the run reach."""
    rk = [*keys, "region_id"]
    spans = row_spans(rules, keys, tol)
    r = regions.select(*rk, *[F.col(s).alias(f"r_{s}") for s in G.SIDES]).join(shuffled(frames.select(*keys, F.col("y0").alias("f_y0"))), keys)
    half = 0.5 * (F.col("r_x1") - F.col("r_x0"))
    each = spans.groupBy(*keys, "y").agg(F.sum(F.col("hi") - F.col("lo")).alias("long"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    long_ = r.join(shuffled(each), keys).filter(
        (F.col("long") >= half) & (F.least("hi", "r_x1") - F.greatest("lo", "r_x0") >= half) & (F.col("y") >= F.col("f_y0") - tol) & (F.col("y") <= F.col("r_y1") + tol)
    )
    heights = long_.groupBy(*rk).agg(F.array_sort(F.collect_set("y")).alias("ys"))
    cols = r.join(shuffled(column_spans(rules, keys, tol)), keys).filter((F.col("x") >= F.col("r_x0") - tol) & (F.col("x") <= F.col("r_x1") + tol))
    verticals = cols.groupBy(*rk).agg(F.array_sort(F.collect_list(F.struct("x", "lo", "hi"))).alias("vs"))
    base = heights.filter(F.size("ys") >= 3).join(shuffled(verticals), rk)
    runs = base.select(*rk, "ys", "vs", F.explode(F.sequence(F.lit(0), F.size("ys") - 3)).alias("start"))
    runs = runs.withColumn("run", row_run(F.col("ys"), F.col("start"))).withColumn("pitch", F.get("run", 1) - F.get("run", 0))
    runs = runs.filter((F.size("run") >= 3) & (F.col("pitch") > 2 * tol))
    tries = F.transform(F.sequence(F.size("run"), F.lit(3), F.lit(-1)), lambda k: F.struct(k.alias("k"), _columns(F.col("vs"), F.get("run", 0), F.element_at("run", k), tol).alias("cols")))
    runs = graph.written(runs)  # each step's expressions are planned by themselves
    runs = runs.withColumn("best", F.get(F.filter(tries, lambda t: F.size(t["cols"]) >= 4), 0)).filter("best IS NOT NULL")
    runs = runs.withColumn("rows", F.slice("run", F.lit(1), F.col("best.k"))).withColumn("last", F.array_position("ys", F.element_at("rows", -1)).cast("int") - 1)
    one = F.struct("start", "last", "rows", F.col("best.cols").alias("cols"), "pitch")
    first = F.struct(F.lit(-1).alias("last"), F.array().cast("array<struct<start:int,last:int,rows:array<double>,cols:array<double>,pitch:double>>").alias("out"))
    take = lambda s, x: F.when(x["start"] >= s["last"], F.struct(x["last"].alias("last"), F.concat(s["out"], F.array(x)).alias("out"))).otherwise(s)
    kept = runs.groupBy(*rk).agg(F.first("ys").alias("ys"), F.first("vs").alias("vs"), F.aggregate(F.array_sort(F.collect_list(one)), first, take)["out"].alias("kept"))
    kept = graph.written(kept.select(*rk, "ys", "vs", F.inline("kept")))
    # x-ranges that all row rules of a run reach across: a sweep over the ends of their spans
    rules_of = kept.select(*rk, "start", "cols", F.size("rows").alias("n"), F.explode("rows").alias("y")).join(shuffled(spans), [*keys, "y"])
    ends = rules_of.select(*rk, "start", "cols", "n", F.inline(F.array(F.struct(F.col("lo").alias("at"), F.lit(1).alias("d")), F.struct(F.col("hi").alias("at"), F.lit(-1).alias("d")))))
    ends = ends.groupBy(*rk, "start", "at").agg(F.sum("d").alias("d"), F.first("n").alias("n"), F.first("cols").alias("cols"))
    w = Window.partitionBy(*rk, "start").orderBy("at")
    ends = ends.withColumns({"open": F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)), "hi": F.lead("at").over(w)})
    common = ends.filter((F.col("open") == F.col("n")) & F.col("hi").isNotNull()).select(*rk, "start", F.col("at").alias("lo"), "hi", "cols")
    common = intervals.runs(common.withColumn("c", F.to_json("cols")), [*rk, "start", "c"], 0.0).select(*rk, "start", "lo", "hi", F.from_json("c", "array<double>").alias("cols"))
    groups = common.withColumn("cols", F.filter("cols", lambda x: (x >= F.col("lo") - tol) & (x <= F.col("hi") + tol))).filter(F.size("cols") >= 4)
    return kept, groups


def _grown(tol: float) -> Column:
    """Rows of a group on rules of its own (``own``) beyond the run's ``rows``; columns as in ``part_lists``."""
    vs, ws, cols, g, rows, own = (F.col(c) for c in ("vs", "ws", "cols", "pitch", "rows", "own"))
    state = lambda out, done: F.struct(out.alias("out"), done.alias("done"))
    low = F.array_sort(F.filter(own, lambda y: y > F.element_at(rows, -1) + tol))
    high = F.reverse(F.array_sort(F.filter(own, lambda y: y < F.get(rows, 0) - tol)))

    def down(s: Column, k: Column) -> Column:
        y, last = F.get(low, k), F.element_at(s["out"], -1)
        h = y - last
        fits = _near(last, y, g) & _same_box(vs, last, y, cols, tol)
        stray = (h < g - F.greatest(F.lit(0.8), 0.12 * g)) & F.coalesce(_near(last, F.get(low, k + 1), g), F.lit(False))
        text = _text(ws, F.get(cols, 0), last, F.element_at(cols, -1), y)
        head = (h < 3 * g) & _same_box(vs, last, y, cols, tol) & (_has(text, HEADS) | ((text == "") & ((h <= 1.5 * g) | (y >= F.col("r_y1") - tol))))
        return F.when(s["done"] | (~fits & stray), s).otherwise(state(F.when(fits | head, F.concat(s["out"], F.array(y))).otherwise(s["out"]), ~fits))

    def up(s: Column, y: Column) -> Column:
        top = F.get(s["out"], 0)
        box = _same_box(vs, y, top, cols, tol)
        fits = _near(y, top, g) & box
        return F.when(s["done"], s).otherwise(state(F.when(fits | ((top - y < 3 * g) & box), F.concat(F.array(y), s["out"])).otherwise(s["out"]), ~fits))

    at = F.when(F.size(low) > 0, F.sequence(F.lit(0), F.size(low) - 1)).otherwise(F.array().cast("array<int>"))
    below = F.aggregate(at, state(rows, F.lit(False)), down, lambda s: s["out"])
    return F.aggregate(high, state(below, F.lit(False)), up, lambda s: s["out"])


def part_lists(rules: DataFrame, words: DataFrame, marks: DataFrame, regions: DataFrame, frames: DataFrame, keys: list[str], tol: float = TOL) -> DataFrame:
    """``keys..., region_id, x0, y0, x1, y1, n_rows, sure, side, rows``: part lists that reach into a region from its top.

    A list has three rules of equal distance at least, four columns, and content in two rows. It starts at the region's
    top or above, and does not end the region, unless it stands beside the rest (``side``). A header below data rows ends
    it. It is ``sure`` when it goes on above the region; one beside the rest also by a header or item numbers, or, without
    words, by rows of its own down to the region's bottom. A list that is not sure stays only with a header or without any
    words; one whose words are those of a revision table is none.
    """
    rk = [*keys, "region_id"]
    runs, groups = lattices(rules, regions, frames, keys, tol)
    r = regions.select(*rk, *[F.col(s).alias(f"r_{s}") for s in G.SIDES]).join(shuffled(frames.select(*keys, F.col("y0").alias("f_y0"))), keys)
    centre = words.select(*keys, "pos", ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"), F.col("text").alias("t"))
    in_x = lambda c: (F.col(c) >= F.col("r_x0") - tol) & (F.col(c) <= F.col("r_x1") + tol)
    texts = r.join(shuffled(centre), keys).filter(in_x("x")).groupBy(*rk).agg(F.array_sort(F.collect_list(F.struct("pos", "x", "y", "t"))).alias("ws"))
    drawn = r.join(shuffled(marks.select(*keys, *G.SIDES)), keys).filter(in_x("x0") & in_x("x1")).groupBy(*rk).agg(F.collect_list(F.struct(*G.SIDES)).alias("ms"))
    none = lambda c, t: F.coalesce(F.col(c), F.array().cast(t))
    about = r.join(shuffled(texts), rk, "left").join(shuffled(drawn), rk, "left").withColumns(
        {"ws": none("ws", "array<struct<pos:bigint,x:double,y:double,t:string>>"), "ms": none("ms", "array<struct<x0:double,y0:double,x1:double,y1:double>>")}
    )
    runs = graph.written(runs.join(shuffled(about), rk))
    # groups of a run that does not reach across all of its columns, each grown on the rules across its own columns
    side = groups.withColumnRenamed("cols", "own_cols").join(shuffled(runs), [*rk, "start"]).filter(F.col("own_cols") != F.col("cols")).withColumn("cols", F.col("own_cols")).drop("own_cols", "lo", "hi")
    all_spans = row_spans(rules, keys, tol).select(*keys, "y", F.col("lo").alias("s0"), F.col("hi").alias("s1"))
    across = side.select(*rk, "start", "cols", "f_y0", "r_y1").join(shuffled(all_spans), keys).filter(
        (F.col("s0") <= F.get("cols", 0) + tol) & (F.col("s1") >= F.element_at("cols", -1) - tol) & (F.col("y") >= F.col("f_y0") - tol) & (F.col("y") <= F.col("r_y1") + tol)
    )
    own = across.groupBy(*rk, "start", "cols").agg(F.collect_set("y").alias("own"))
    side = graph.written(side.join(shuffled(own), [*rk, "start", "cols"]).withColumn("band", F.col("rows")).withColumn("rows", _grown(tol)))
    told = F.exists(_bands(F.col("rows")), lambda b: _has(_text(F.col("ws"), F.get("cols", 0), b["a"], F.element_at("cols", -1), b["b"]), HEADS)) | _items(F.col("ws"), F.col("rows"), F.col("cols"))
    side = side.withColumns({"n": F.size("rows"), "told": told, "wide": F.element_at("cols", -1) - F.get("cols", 0)})
    w = Window.partitionBy(*rk, "start")
    by_rank = w.orderBy(F.desc("n"), F.desc("told"), F.desc("wide"), F.col("cols"))
    side = side.withColumns({"rank": F.row_number().over(by_rank), "n_next": F.lead("n").over(by_rank), "told_next": F.lead("told").over(by_rank)}).filter("rank = 1")
    apart = F.col("n_next").isNull() | (F.col("n_next") != F.col("n")) | (F.col("told_next") != F.col("told"))
    side = side.filter(apart & ((F.get("cols", 0) > F.col("r_x0") + tol) | (F.element_at("cols", -1) < F.col("r_x1") - tol)))
    found = _judged(graph.written(side.withColumn("side", F.lit(True))), rk, tol)
    alone = runs.join(shuffled(found.select(*rk, "start")), [*rk, "start"], "left_anti").withColumns({"band": F.col("rows"), "side": F.lit(False)})
    return found.unionByName(_judged(graph.written(_with_tall_rows(alone, tol)), rk, tol)).drop("start")


def _with_tall_rows(df: DataFrame, tol: float) -> DataFrame:
    """A run over all columns takes one more row above and below, of up to three times the height (below: a header)."""
    ys, vs, ws, cols, g, rows = (F.col(c) for c in ("ys", "vs", "ws", "cols", "pitch", "rows"))
    i, k = F.array_position(ys, F.get(rows, 0)).cast("int") - 1, F.array_position(ys, F.element_at(rows, -1)).cast("int") - 1
    before, after = F.get(ys, F.greatest(i - 1, F.lit(0))), F.get(ys, k + 1)
    goes_up = (i > 0) & _same_inner(vs, before, F.get(rows, 0), cols, tol)
    text = _text(ws, F.get(cols, 0), F.element_at(rows, -1), F.element_at(cols, -1), after)
    high = after - F.element_at(rows, -1)
    head = after.isNotNull() & (high < 3 * g) & _same_inner(vs, F.element_at(rows, -1), after, cols, tol) & (_has(text, HEADS) | ((text == "") & (high <= 1.5 * g)))
    none = F.array().cast("array<double>")
    taken = F.concat(F.when(goes_up & (F.get(rows, 0) - before < 3 * g), F.array(before)).otherwise(none), rows, F.when(F.coalesce(head, F.lit(False)), F.array(after)).otherwise(none))
    return df.withColumns({"up": F.coalesce(goes_up, F.lit(False)), "rows": taken})


def _judged(df: DataFrame, rk: list[str], tol: float) -> DataFrame:
    ws, ms, cols, rows = (F.col(c) for c in ("ws", "ms", "cols", "rows"))
    df = df if "up" in df.columns else df.withColumn("up", F.get(rows, 0) < F.get("band", 0) - tol)
    left, right = F.get(cols, 0), F.element_at(cols, -1)
    heads = F.transform(_bands(rows), lambda b: _has(_text(ws, left, b["a"], right, b["b"]), HEADS))
    df = df.withColumn("head", F.array_position(heads, F.lit(True)).cast("int"))  # from 1, 0 for none
    ends = (F.col("head") > 0) & ((F.col("head") > 1) | F.col("up"))
    df = df.withColumn("rows", F.when(ends, F.slice(rows, F.lit(1), F.col("head") + 1)).otherwise(rows))
    df = df.withColumns({"x0": left, "y0": F.get(rows, 0), "x1": right, "y1": F.element_at(rows, -1), "n_rows": F.size(rows) - 1})
    df = graph.written(df.withColumn("text", _text(ws, F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))))
    inner = lambda b, x, y: (x >= left + 0.5) & (x <= right - 0.5) & (y >= b["a"] + 0.5) & (y <= b["b"] - 0.5)
    full = F.size(F.filter(_bands(rows), lambda b: F.exists(ws, lambda w: inner(b, w["x"], w["y"])) | F.exists(ms, lambda m: inner(b, m["x0"], m["y0"]) & inner(b, m["x1"], m["y1"]))))
    side, has_head, silent = F.col("side"), F.col("head") > 0, F.col("text") == ""
    above = F.col("y0") < F.col("r_y0") - tol
    low = F.col("y1") >= F.col("r_y1") - tol
    mark = has_head | _items(ws, rows, cols)
    more = F.size(F.filter(rows, lambda y: y > F.element_at("band", -1) + tol)) >= 2
    df = df.withColumns({"mark": mark, "low": low, "full": full})
    df = df.withColumn("sure", F.when(side, above | F.col("mark") | (silent & F.col("low") & more)).otherwise(above))
    own_grid = side & F.col("low") & ~F.col("mark") & (~silent | (F.col("n_rows") < 6))
    revision = _has(F.col("text"), REVISIONS) & ~_has(F.col("text"), PARTS)
    enters = (F.col("y0") <= F.col("r_y0") + tol) & (F.col("r_y0") + tol < F.col("y1"))
    ok = ~own_grid & enters & (~F.col("low") | side) & (F.col("full") >= 2) & ~revision & (F.col("sure") | has_head | silent) & (F.col("sure") | ~side)
    return df.filter(ok).select(*rk, "start", *G.SIDES, "n_rows", "sure", "side", "rows")


def cleared(regions: DataFrame, lists: DataFrame, rules: DataFrame, frames: DataFrame, keys: list[str], tol: float = TOL) -> DataFrame:
    """``keys..., region_id, piece, x0, y0, x1, y1``: regions on the frame's bottom without the lists, others as they are.

    A list as wide as the region moves its top down to the list's last rule. Beside one that stands at the side, the
    region stays, and goes up along the rows that it shares with the list as long as their rules reach across it; what
    lies below such a list stays too. Lists cut one after another, from the top.
    """
    rk = [*keys, "region_id"]
    r = regions.select(*rk, *G.SIDES).join(shuffled(frames.select(*keys, F.col("y1").alias("f_y1"))), keys)
    every = lists.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("y0", "x0", "x1", "y1", "side", "rows"))).alias("ls"))
    spans = row_spans(rules, keys, tol).groupBy(*keys).agg(F.collect_list(F.struct("y", "lo", "hi")).alias("hs"))
    box = lambda x0, y0, x1, y1: F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))
    none = F.array().cast("array<struct<x0:double,y0:double,x1:double,y1:double>>")

    def beside(q: Column, t: Column, a: Column, b: Column) -> Column:
        reach = lambda y: F.exists("hs", lambda h: (F.abs(h["y"] - y) <= tol) & (h["lo"] <= a + tol) & (h["hi"] >= b - tol))
        shared = F.reverse(F.array_sort(F.filter(t["rows"], lambda y: y < q["y0"] - tol)))
        start = F.struct(q["y0"].alias("top"), F.lit(False).alias("done"))
        top = F.aggregate(shared, start, lambda s, y: F.when(s["done"] | ~reach(y), F.struct(s["top"].alias("top"), F.lit(True).alias("done"))).otherwise(F.struct(y.alias("top"), F.lit(False).alias("done"))), lambda s: s["top"])
        return F.when(b - a > tol, F.array(box(a, top, b, q["y1"]))).otherwise(none)

    def cut(q: Column, t: Column) -> Column:
        common = F.least(q["x1"], t["x1"]) - F.greatest(q["x0"], t["x0"])
        whole = F.when(
            (t["y0"] - tol <= q["y0"]) & (q["y0"] < t["y1"] - tol) & (common > 0.5 * F.least(q["x1"] - q["x0"], t["x1"] - t["x0"])), F.array(box(q["x0"], t["y1"], q["x1"], q["y1"]))
        ).otherwise(F.array(q))
        below = F.when(t["y1"] < q["y1"] - tol, F.array(box(q["x0"], t["y1"], q["x1"], q["y1"]))).otherwise(none)
        apart = (common <= tol) | (q["y0"] >= t["y1"] - tol)
        return F.when(~t["side"], whole).when(apart, F.array(q)).otherwise(F.concat(beside(q, t, q["x0"], t["x0"]), beside(q, t, t["x1"], q["x1"]), below))

    first = F.array(box(*[F.col(s) for s in G.SIDES]))
    pieces = F.aggregate("ls", first, lambda qs, t: F.flatten(F.transform(qs, lambda q: cut(q, t))))
    out = r.join(shuffled(every), keys, "left").join(shuffled(spans), keys, "left").withColumn("hs", F.coalesce("hs", F.array().cast("array<struct<y:double,lo:double,hi:double>>")))
    out = out.withColumn("qs", F.when((F.col("y1") < F.col("f_y1") - tol) | F.col("ls").isNull(), first).otherwise(pieces))
    return out.select(*rk, F.posexplode("qs").alias("piece", "q")).select(*rk, "piece", "q.*")
