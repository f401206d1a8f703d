"""Title blocks, corner boxes, rule trimming, path pieces, and searches for a scale or a place."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions import geometry as G
from rivulet.operators import graph, joins


def title_rows(rules: DataFrame, frames: DataFrame, keys: list[str], tol: float = 1.5) -> DataFrame:
    """``keys..., row_id, x0, y0, x1, y1``: rows of the title block, from each row's rule down to the frame.

    ``rules``: long rules ``keys, orient, lo, hi, coord``; ``frames``: ``keys, x0, y0, x1, y1``. A row is a horizontal
    rule in the lower half whose left end has a vertical rule down to the bottom and whose right end meets the frame
    edge or another such rule. Only rows tied to the right edge by a chain of touching rows belong.
    """
    f = frames.select(*keys, *[F.col(s).alias(f"f_{s}") for s in G.SIDES])
    r = rules.join(f, keys)
    h = r.filter("orient = 'H'").filter((F.col("coord") > F.col("f_y0") + 0.5 * (F.col("f_y1") - F.col("f_y0"))) & (F.col("coord") < F.col("f_y1") - 2))
    h = h.drop("orient").distinct().withColumn("row_id", F.xxhash64(*keys, "lo", "hi", "coord"))
    down = r.filter((F.col("orient") == "V") & (F.col("hi") >= F.col("f_y1") - tol)).select(*keys, F.floor(F.col("coord") / (2 * tol)).alias("bin"), F.col("coord").alias("v"), F.col("lo").alias("v_lo"))
    # an end meets a rule in its own bin of 2 tol or a neighbouring one: an equi-join on bins
    def meets(rows: DataFrame, end: str, from_row: bool) -> DataFrame:
        near = rows.withColumn("bin", F.explode(F.array(*[F.floor(F.col(end) / (2 * tol)) + d for d in (-1, 0, 1)])))
        ok = F.abs(F.col("v") - F.col(end)) < tol
        if from_row:
            ok = ok & (F.col("v_lo") <= F.col("coord") + tol)
        return near.join(down, [*keys, "bin"]).filter(ok).select(*keys, "row_id").distinct()

    left = meets(h, "lo", True)
    right = meets(h, "hi", False).unionByName(h.filter(F.abs(F.col("hi") - F.col("f_x1")) < tol).select(*keys, "row_id")).distinct()
    rows = graph.written(h.join(left, [*keys, "row_id"], "left_semi").join(right, [*keys, "row_id"], "left_semi"))
    ends = rows.select(*keys, F.col("row_id").alias("a"), F.col("lo").alias("e"), F.explode(F.array(*[F.floor(F.col("lo") / (2 * tol)) + d for d in (-1, 0, 1)])).alias("bin"))
    tops = rows.select(*keys, F.col("row_id").alias("b"), F.col("hi").alias("g"), F.floor(F.col("hi") / (2 * tol)).alias("bin"))
    edges = ends.join(tops, [*keys, "bin"]).filter(F.abs(F.col("e") - F.col("g")) < tol).select("a", "b")
    seeds = rows.filter(F.abs(F.col("hi") - F.col("f_x1")) < tol).select(F.col("row_id").alias("v"))
    kept = graph.reachable(seeds, edges).withColumnRenamed("v", "row_id")
    return rows.join(kept, "row_id", "left_semi").select(*keys, "row_id", F.col("lo").alias("x0"), F.col("coord").alias("y0"), F.col("hi").alias("x1"), F.col("f_y1").alias("y1"))


def corner_boxes(rules: DataFrame, frames: DataFrame, keys: list[str], tol: float = 1.5) -> DataFrame:
    """``keys..., x0, y0, x1, y1``: boxes under 25 % x 15 % closed by a horizontal and a vertical rule at a frame corner."""
    f = frames.select(*keys, *[F.col(s).alias(f"f_{s}") for s in G.SIDES])
    r = rules.join(f, keys)
    w, t = F.col("f_x1") - F.col("f_x0"), F.col("f_y1") - F.col("f_y0")
    h = r.filter((F.col("orient") == "H") & (F.col("hi") - F.col("lo") <= 0.25 * w))
    sides = F.filter(
        F.array(F.when(F.abs(F.col("lo") - F.col("f_x0")) <= tol, F.col("hi")), F.when(F.abs(F.col("hi") - F.col("f_x1")) <= tol, F.col("lo"))), lambda e: e.isNotNull()
    )
    h = h.withColumn("free", F.explode(sides)).withColumn("top", F.explode(F.array(F.lit(True), F.lit(False))))
    deep = F.when(F.col("top"), F.col("coord") - F.col("f_y0")).otherwise(F.col("f_y1") - F.col("coord"))
    h = h.filter((deep > 0.01 * t) & (deep < 0.15 * t)).withColumn("bin", F.explode(F.array(*[F.floor(F.col("free") / (2 * tol)) + d for d in (-1, 0, 1)])))
    v = r.filter("orient = 'V'").select(*keys, F.floor(F.col("coord") / (2 * tol)).alias("bin"), F.col("coord").alias("v"), F.col("lo").alias("v0"), F.col("hi").alias("v1"))
    edge = F.when(F.col("top"), F.col("f_y0")).otherwise(F.col("f_y1"))
    hit = h.join(v, [*keys, "bin"]).filter((F.abs(F.col("v") - F.col("free")) < tol) & (F.col("v0") <= F.least("coord", edge) + tol) & (F.col("v1") >= F.greatest("coord", edge) - tol))
    return hit.select(
        *keys, F.col("lo").alias("x0"), F.when(F.col("top"), F.col("f_y0")).otherwise(F.col("coord")).alias("y0"), F.col("hi").alias("x1"), F.when(F.col("top"), F.col("coord")).otherwise(F.col("f_y1")).alias("y1")
    ).distinct()


def fractions(boxes: DataFrame, frames: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., x0, y0, x1, y1`` of boxes as fractions of their frame, distinct, without those inside others."""
    f = frames.select(*keys, *[F.col(s).alias(f"f_{s}") for s in G.SIDES])
    j = boxes.join(f, keys)
    out = j.select(*keys, *[G.fraction(F.col(s), F.col(f"f_{s[0]}0"), F.col(f"f_{s[0]}1")).alias(s) for s in G.SIDES]).distinct()
    out = out.withColumn("__id", F.xxhash64(*keys, *G.SIDES))
    pairs = joins.box_join(out, out, keys, cell=0.25)
    inside = pairs.filter((F.col("a___id") != F.col("b___id")) & G.contains(G.of("b_"), G.of("a_"))).select(*keys, F.col("a___id").alias("__id")).distinct()
    return out.join(inside, [*keys, "__id"], "left_anti").drop("__id")


def trim_rules(rules: DataFrame, areas: DataFrame, keys: list[str], id_: str, slack: float = 0.6, least: float = 1.0) -> DataFrame:
    """Axis-parallel rules that run into a removed area end at its edge; the first area that cuts wins.

    ``rules``: ``keys, id, orient, coord, lo, hi``; ``areas``: ``keys, area_id, x0, y0, x1, y1``. Adds nothing, changes
    ``lo`` or ``hi``.
    """
    h = F.col("orient") == "H"
    box = rules.withColumns({"x0": F.when(h, F.col("lo")).otherwise(F.col("coord")), "x1": F.when(h, F.col("hi")).otherwise(F.col("coord")), "y0": F.when(h, F.col("coord")).otherwise(F.col("lo")), "y1": F.when(h, F.col("coord")).otherwise(F.col("hi"))})
    p = joins.box_join(box, areas, keys, slack, cell=128.0)
    ah = F.col("a_orient") == "H"
    near, far = F.when(ah, F.col("b_x0")).otherwise(F.col("b_y0")), F.when(ah, F.col("b_x1")).otherwise(F.col("b_y1"))
    c0, c1 = F.when(ah, F.col("b_y0")).otherwise(F.col("b_x0")), F.when(ah, F.col("b_y1")).otherwise(F.col("b_x1"))
    c, lo, hi = F.col("a_coord"), F.col("a_lo"), F.col("a_hi")
    within = lambda x: (x >= near - slack) & (x <= far + slack) & (c >= c0 - slack) & (c <= c1 + slack)
    crosses = F.when(ah, c > c0 + slack).otherwise((c > c0 + slack) & (c < c1 - slack))
    p = p.filter(within(lo) != within(hi)).filter(crosses)
    start_in = within(lo)
    new_lo, new_hi = F.when(start_in, F.when(hi < near, near).otherwise(far)).otherwise(lo), F.when(start_in, hi).otherwise(F.when(lo < near, near).otherwise(far))
    p = p.withColumns({"n_lo": new_lo, "n_hi": new_hi}).filter(F.when(start_in, F.abs(lo - F.col("n_lo")) > least).otherwise(F.abs(hi - F.col("n_hi")) > least))
    w = Window.partitionBy(*keys, f"a_{id_}").orderBy("b_area_id")
    first = p.withColumn("__r", F.row_number().over(w)).filter("__r = 1").select(*keys, F.col(f"a_{id_}").alias(id_), "n_lo", "n_hi")
    out = rules.join(first, [*keys, id_], "left")
    return out.withColumns({"lo": F.coalesce("n_lo", "lo"), "hi": F.coalesce("n_hi", "hi")}).drop("n_lo", "n_hi")


def path_pieces(items: DataFrame, keys: list[str], path: str, id_: str, gap: float, least: int = 20) -> DataFrame:
    """``v, piece``: items of paths with at least ``least`` items, split where pieces lie apart; others stay whole."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys, path))
    named = items.withColumn("__n", n)
    big = named.filter(F.col("__n") >= least).drop("__n")
    comp = graph.box_components(big, [*keys, path], id_, gap)
    whole = named.filter(F.col("__n") < least).select(F.col(id_).alias("v"), F.min(id_).over(Window.partitionBy(*keys, path)).alias("comp"))
    return comp.unionByName(whole).withColumnRenamed("comp", "piece")


def prefix_sums(cells: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., ix, iy, s``: number of occupied cells at or below each cell of the page's grid, by two windows."""
    ext = cells.groupBy(*keys).agg(F.max("ix").alias("mx"), F.max("iy").alias("my"))
    grid = ext.select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("mx"))).alias("ix"), "my").select(*keys, "ix", F.explode(F.sequence(F.lit(0).cast("long"), F.col("my"))).alias("iy"))
    full = grid.join(cells.select(*keys, "ix", "iy", F.lit(1).cast("long").alias("o")), [*keys, "ix", "iy"], "left")
    up = Window.partitionBy(*keys, "ix").orderBy("iy").rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy(*keys, "iy").orderBy("ix").rowsBetween(Window.unboundedPreceding, 0)
    return full.withColumn("c", F.sum(F.coalesce("o", F.lit(0))).over(up)).withColumn("s", F.sum("c").over(across)).select(*keys, "ix", "iy", "s")


def _grid_sums(xs: pd.Series, ys: pd.Series) -> pd.Series:
    """Prefix sums of each page's occupied cells, column after column."""

    def one(x, y):
        grid = np.zeros((max(x) + 1, max(y) + 1), np.int32)
        grid[x, y] = 1
        return grid.cumsum(0).cumsum(1).ravel()

    return pd.Series([one(x, y) for x, y in zip(xs, ys)])


def first_clear(cells: DataFrame, candidates: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """The first candidate (by rank) whose cells ``ix0..ix1, iy0..iy1`` hold nothing; one per key.

    The count in a rectangle is four look-ups in the page's prefix sums, one array a page; beyond the grid lies nothing.
    Candidates may be many to a page: they stream past these arrays (hashed, not sorted), and only the first one is kept.
    """
    p = cells.groupBy(*keys).agg(F.collect_list("ix").alias("__x"), F.collect_list("iy").alias("__y"), F.max("ix").alias("__mx"), F.max("iy").alias("__my"))
    p = p.select(*keys, "__mx", "__my", F.pandas_udf(_grid_sums, "array<int>")("__x", "__y").alias("__s"))
    out = candidates.join(p.hint("shuffle_hash"), keys, "left")

    def upto(x: Column, y: Column) -> Column:
        x, y = F.least(x, F.col("__mx")), F.least(y, F.col("__my"))
        return F.when((x >= 0) & (y >= 0), F.coalesce(F.get("__s", (x * (F.col("__my") + 1) + y).cast("int")), F.lit(0))).otherwise(0)

    x0, y0, x1, y1 = (F.col(c) for c in ("ix0", "iy0", "ix1", "iy1"))
    clear = out.filter(F.col("__s").isNull() | (upto(x1, y1) - upto(x0 - 1, y1) - upto(x1, y0 - 1) + upto(x0 - 1, y0 - 1) == 0))
    rest = [c for c in candidates.columns if c not in keys]
    return clear.groupBy(*keys).agg(*[F.min_by(c, rank).alias(c) for c in rest]).select(*candidates.columns)


def packed_rows(sizes: Column, scale: Column, width: float, height: float, gap: float, corner: tuple[float, float] | None = None) -> Column:
    """Corners ``x, y`` of boxes (array of ``w, h``) set left to right in rows at a scale, in order; null if they do not fit.

    ``corner``: the upper left of a reserved area that reaches to the lower right; a row that comes down to it ends there.
    """
    none = F.array().cast("array<struct<x:double,y:double>>")
    state = lambda x, y, tall, ok, out: F.struct(x.alias("x"), y.alias("y"), tall.alias("tall"), ok.alias("ok"), out.alias("out"))
    zero = F.lit(0.0)

    def end(y: Column, h: Column) -> Column:
        return F.lit(width) if corner is None else F.when(y + h > corner[1], F.lit(corner[0])).otherwise(F.lit(width))

    def step(s: Column, b: Column) -> Column:
        w, h = b["w"] * scale, b["h"] * scale
        wraps = (s["x"] > 0) & (s["x"] + w > end(s["y"], F.greatest(s["tall"], h)))
        x, y, tall = F.when(wraps, zero).otherwise(s["x"]), F.when(wraps, s["y"] + s["tall"] + gap).otherwise(s["y"]), F.when(wraps, zero).otherwise(s["tall"])
        ok = s["ok"] & (x + w <= end(y, h)) & (y + h <= height)
        return state(x + w + gap, y, F.greatest(tall, h), ok, F.concat(s["out"], F.array(F.struct(x.alias("x"), y.alias("y")))))

    return F.aggregate(sizes, state(zero, zero, zero, F.lit(True), none), step, lambda s: F.when(s["ok"], s["out"]))


def largest_scale(boxes: DataFrame, keys: list[str], order: str, width: float, height: float, gap: float = 12.0, least: float = 0.0, most: float = 3.0, steps: int = 40, corner: tuple[float, float] | None = None) -> DataFrame:
    """``keys..., scale``: the largest scale between bounds at which a page's boxes fit in rows, by bisection; null if none does.

    A fold of ``steps`` halvings, each over the array of one page's boxes.
    """
    item = F.struct(F.col(order).alias("o"), (F.col("x1") - F.col("x0")).cast("double").alias("w"), (F.col("y1") - F.col("y0")).cast("double").alias("h"))
    per = boxes.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("__s"))

    def halve(s: Column, _: Column) -> Column:
        mid = (s["low"] + s["high"]) / 2
        fits = packed_rows(F.col("__s"), mid, width, height, gap, corner).isNotNull()
        return F.struct(F.when(fits, mid).otherwise(s["low"]).alias("low"), F.when(fits, s["high"]).otherwise(mid).alias("high"))

    start = F.struct(F.lit(float(least)).alias("low"), F.lit(float(most)).alias("high"))
    low = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda s: s["low"])
    return per.select(*keys, low.alias("scale")).withColumn("scale", F.when(F.col("scale") > least, F.col("scale")))


def label_fields(words: DataFrame, lines: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., field, value, flag``: the text of the cell around each label.

    ``words``: ``keys, word_id, x0, y0, x1, y1, text``; ``labels``: ``field, label``. The topmost word that holds the
    label; its cell between the nearest lines; the cell's words in reading order; the part behind the colon.
    """
    hit = words.withColumn("__l", F.lit(1)).join(F.broadcast(labels.withColumn("__l", F.lit(1))), "__l").filter(F.contains(F.col("text"), F.col("label")))
    w = Window.partitionBy(*keys, "field").orderBy("y0", "x0", "word_id")
    lab = hit.withColumn("__r", F.row_number().over(w)).filter("__r = 1")
    pts = lab.select(*keys, "field", "label", ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"))
    cell = joins.span_lines(pts, lines, [*keys], "field")
    low, high = F.lit(-1e9), F.lit(1e9)
    rect = cell.select(*keys, "field", F.coalesce("left", low).alias("x0"), F.coalesce("top", low).alias("y0"), F.coalesce("right", high).alias("x1"), F.coalesce("bottom", high).alias("y1"))
    inner = words.select(*keys, F.col("x0").alias("wx"), ((F.col("x0") + F.col("x1")) / 2).alias("cx"), ((F.col("y0") + F.col("y1")) / 2).alias("cy"), "text").join(rect, keys)
    inner = inner.filter(F.col("cx").between(F.col("x0"), F.col("x1")) & F.col("cy").between(F.col("y0"), F.col("y1")))
    joined = inner.groupBy(*keys, "field").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.rint("cy").alias("r"), "wx", "text"))), lambda s: s["text"]), " ").alias("t"))
    value = F.trim(F.coalesce(F.get(F.split("t", "[:：]", 2), 1), F.lit("")))
    return joined.select(*keys, "field", F.when(value != "", value).alias("value"), F.when(value == "", "VALUE_NOT_TEXT_NEEDS_READ").alias("flag"))


def title_anchor(words: DataFrame, lines: DataFrame, pages: DataFrame, labels: list[str], top_label: str, keys: list[str]) -> DataFrame:
    """``keys..., x0, y0, x1, y1, status``: the title block found by its own labels, never by its place.

    ``words``: ``keys, word_id, x0..y1, text``; ``lines``: ``keys, orient, coord, lo, hi, width``; ``pages``: ``keys, x1, y1``. Words that
    hold a label are the block's. Its top is the lowest level rule up to 15 above the topmost word with the top label (without
    one, of all), over that word's middle; its left side the upright rule nearest to the leftmost of the words below the top,
    within 8, from the top down 20 at least. It reaches the page's lower right corner. Status: OK, NO_LABEL, NO_TOP_RULE,
    NO_LEFT_RULE; the box is null unless OK. Lines meet one word a page, so the joins give a row a line.
    """
    holds = F.exists(F.array(*map(F.lit, labels)), lambda v: F.contains(F.col("text"), v))
    own = words.filter(holds).withColumn("__top", F.contains("text", F.lit(top_label)))
    first = own.groupBy(*keys).agg(F.min(F.struct((~F.col("__top")).alias("o"), F.col("y0").alias("y"), "word_id", ((F.col("x0") + F.col("x1")) / 2).alias("x"))).alias("w"))
    at = first.select(*keys, F.col("w.y").alias("wy"), F.col("w.x").alias("wx"))
    level = lines.filter("orient = 'H'").join(at, keys).filter(F.col("coord").between(F.col("wy") - 15, F.col("wy") + 0.5) & (F.col("lo") - 0.8 <= F.col("wx")) & (F.col("hi") + 0.8 >= F.col("wx")))
    top = level.groupBy(*keys).agg(F.max(F.struct("coord", "width")).alias("t")).select(*keys, F.col("t.coord").alias("ty"), F.col("t.width").alias("tw"))
    left_word = own.select(*keys, F.col("x0").alias("lx"), "y0").join(top, keys).filter(F.col("y0") >= F.col("ty") - 1).groupBy(*keys).agg(F.min("lx").alias("lx"))
    upright = lines.filter("orient = 'V'").join(top, keys).join(left_word, keys)
    upright = upright.filter((F.abs(F.col("coord") - F.col("lx")) <= 8) & (F.col("lo") - 1 <= F.col("ty") + 5) & (F.col("hi") >= F.col("ty") + 20))
    left = upright.groupBy(*keys).agg(F.min(F.struct(F.abs(F.col("coord") - F.col("lx")).alias("d"), "coord", "width")).alias("v"))
    p = pages.select(*keys, F.col("x1").alias("px"), F.col("y1").alias("py")).join(at, keys, "left").join(top, keys, "left").join(left, keys, "left")
    status = F.when(F.col("wy").isNull(), "NO_LABEL").when(F.col("ty").isNull(), "NO_TOP_RULE").when(F.col("v").isNull(), "NO_LEFT_RULE").otherwise("OK")
    box = {"x0": F.col("v.coord") - F.col("v.width") / 2 - 0.3, "y0": F.col("ty") - F.col("tw") / 2 - 0.3, "x1": F.col("px"), "y1": F.col("py")}
    p = p.withColumn("status", status)
    return p.select(*keys, *[F.when(F.col("status") == "OK", v).alias(k) for k, v in box.items()], "status")
