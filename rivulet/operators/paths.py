"""Drawn paths as tables of items: primitives, segments, the frame they make, and what of them is drawing.

An item (``keys, path_id, item_id, op, pts, stroked, width``) is a piece of a path: ``op`` is ``l`` (two points), ``re`` (two
corners), ``qu`` (upper left, upper right, lower left, lower right) or ``c`` (four control points); ``pts`` is an array of
structs of ``x`` and ``y``. Items without points make nothing. What is decided per path are windows or aggregates over the
path's items; frames and removed areas join on the page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions import geometry as G
from rivulet.operators.intervals import collinear

# Slack of a level rule, its share of the length, least length of an edge, slack of a removed area.
LEVEL, LEVEL_SHARE, EDGE, AREA = 0.3, 0.002, 1.0, 0.6


def with_ends(items: DataFrame) -> DataFrame:
    """Adds the box ``x0..y1`` of an item's points and its ends ``ax, ay, bx, by`` (first and last point, or corners)."""
    end = F.when(F.col("op").isin("l", "re"), F.get("pts", 1)).otherwise(F.get("pts", 3))
    of = lambda f, c: f(F.transform("pts", lambda p: p[c]))
    out = items.filter(F.size("pts") > 0).withColumns({"x0": of(F.array_min, "x"), "y0": of(F.array_min, "y"), "x1": of(F.array_max, "x"), "y1": of(F.array_max, "y")})
    return out.withColumns({"ax": F.get("pts", 0)["x"], "ay": F.get("pts", 0)["y"], "bx": end["x"], "by": end["y"]})


def primitives(items: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(items with their stroke's box and, for level lines, ``orient, coord, lo, hi``; straight lines of the page).

    Half the width pads a box only where there is a stroke. A line is level if its ends differ by less than 0.3 across and
    more than 1 along. A stroked rectangle gives its four edges as lines, each only if longer than 1.
    """
    pad = F.when(F.coalesce(F.col("stroked"), F.lit(False)), F.coalesce("width", F.lit(0.0)) / 2).otherwise(0.0)
    e = with_ends(items)
    dx, dy = F.abs(F.col("ax") - F.col("bx")), F.abs(F.col("ay") - F.col("by"))
    flat = (F.col("op") == "l") & (dy < LEVEL) & (dx > EDGE)
    steep = (F.col("op") == "l") & ~flat & (dx < LEVEL) & (dy > EDGE)
    pick = lambda a, b: F.when(flat, a).when(steep, b)
    mid = lambda a, b: (F.col(a) + F.col(b)) / 2
    out = e.select(
        *keys, "path_id", "item_id", (F.col("x0") - pad).alias("x0"), (F.col("y0") - pad).alias("y0"), (F.col("x1") + pad).alias("x1"), (F.col("y1") + pad).alias("y1"), "width",
        pick(F.lit("H"), F.lit("V")).alias("orient"), pick(mid("ay", "by"), mid("ax", "bx")).alias("coord"), pick(F.col("x0"), F.col("y0")).alias("lo"), pick(F.col("x1"), F.col("y1")).alias("hi"),
    )
    edge = lambda o, c, a, b: F.struct(F.lit(o).alias("orient"), F.col(c).alias("coord"), F.col(a).alias("lo"), F.col(b).alias("hi"))
    four = F.array(edge("H", "y0", "x0", "x1"), edge("H", "y1", "x0", "x1"), edge("V", "x0", "y0", "y1"), edge("V", "x1", "y0", "y1"))
    edges = e.filter((F.col("op") == "re") & F.coalesce("stroked", F.lit(False))).select(*keys, "path_id", "item_id", "width", F.inline(F.filter(four, lambda s: s["hi"] - s["lo"] > EDGE)))
    names = [*keys, "path_id", "item_id", "orient", "coord", "lo", "hi", "width"]
    return out, out.filter("orient IS NOT NULL").select(*names).unionByName(edges.select(*names))


def segments(items: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., path_id, orient, coord, lo, hi``: axis-parallel lines and the edges of rectangles and upright quads.

    A line may be off level by 0.3 or 0.2 % of its length, the greater; one that is both level and upright gives two. A
    rectangle gives two edges each way, and so does a quad whose corners fall in two pairs on both axes.
    """
    e = with_ends(items)
    dx, dy = F.abs(F.col("ax") - F.col("bx")), F.abs(F.col("ay") - F.col("by"))
    tol = F.greatest(F.lit(LEVEL), LEVEL_SHARE * (dx + dy))
    seg = lambda o, c, a, b: F.struct(F.lit(o).alias("orient"), c.alias("coord"), F.col(a).alias("lo"), F.col(b).alias("hi"))
    line = F.array(F.when(dy < tol, seg("H", (F.col("ay") + F.col("by")) / 2, "x0", "x1")), F.when(dx < tol, seg("V", (F.col("ax") + F.col("bx")) / 2, "y0", "y1")))
    sides = F.array(seg("H", F.col("y0"), "x0", "x1"), seg("H", F.col("y1"), "x0", "x1"), seg("V", F.col("x0"), "y0", "y1"), seg("V", F.col("x1"), "y0", "y1"))

    def paired(c: str) -> Column:
        s = F.array_sort(F.transform("pts", lambda p: p[c]))
        return (F.get(s, 1) - F.get(s, 0) < LEVEL) & (F.get(s, 3) - F.get(s, 2) < LEVEL)

    upright = (F.col("op") == "re") | ((F.col("op") == "qu") & paired("x") & paired("y"))
    found = F.when(F.col("op") == "l", F.array_compact(line)).when(upright, sides)
    return e.select(*keys, "path_id", F.inline(found))


def boxes(items: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., path_id, x0, y0, x1, y1, n, straight``: a path's box, its number of items, and whether all are lines."""
    side = lambda c: (F.min if c.endswith("0") else F.max)(c).alias(c)
    return with_ends(items).groupBy(*keys, "path_id").agg(*[side(c) for c in G.SIDES], F.count(F.lit(1)).alias("n"), F.bool_and(F.col("op") == "l").alias("straight"))


def on_page(paths: DataFrame, pages: DataFrame, keys: list[str], margin: float = 0.1) -> DataFrame:
    """Paths whose centre lies on the page or at most ``margin`` of its size beside it; all of a page's, if none does.

    ``paths``: ``keys, x0..y1`` and others; ``pages``: ``keys, x0..y1``. A path of an unknown page goes.
    """
    p = pages.select(*keys, *[F.col(s).alias(f"p_{s}") for s in G.SIDES])
    w, h = F.col("p_x1") - F.col("p_x0"), F.col("p_y1") - F.col("p_y0")
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    near = cx.between(F.col("p_x0") - margin * w, F.col("p_x1") + margin * w) & cy.between(F.col("p_y0") - margin * h, F.col("p_y1") + margin * h)
    named = paths.join(p, keys).withColumn("__near", F.coalesce(near, F.lit(False)))
    some = F.max("__near").over(Window.partitionBy(*keys))
    return named.withColumn("__some", some).filter(F.col("__near") | ~F.col("__some")).select(*paths.columns)


POLICIES = ("innermost", "title_top", "inner_ring")


def inner_frame(segs: DataFrame, extents: DataFrame, keys: list[str], policy: str | Column | list[str] | tuple[str, ...] = "innermost", search: float = 0.12, share: float = 0.6) -> DataFrame:
    """``keys..., x0, y0, x1, y1, status``: the inner frame of a page by its long rules; null and FRAME_NOT_FOUND without.

    ``extents``: ``keys, x0..y1`` of all that is drawn. On each side it is the innermost rule of ``share`` of the extent whose
    distance from the extent's edge is under ``search`` of it. The bottom follows a policy: ``innermost``; ``title_top``, the
    highest rule of 0.9 of the width in the last fifth of the height, where a title block spans the sheet; ``inner_ring``, the
    second line from the edge, lines within 1 of the one outside counting as it. Several policies share one pass over the
    rules and give a row each, with ``policy``.
    """
    e = extents.select(*keys, *[F.col(s).alias(f"e_{s}") for s in G.SIDES])
    rules = collinear(segs, [*keys, "orient"], 0.0).join(e, keys)
    h, c = F.col("orient") == "H", F.col("coord")
    wide, high = F.col("e_x1") - F.col("e_x0"), F.col("e_y1") - F.col("e_y0")
    long = F.col("covered") >= share * F.when(h, wide).otherwise(high)
    bottom = h & long & (c > F.col("e_y1") - search * high)
    found = rules.groupBy(*keys).agg(
        F.max(F.when(~h & long & (c < F.col("e_x0") + search * wide), c)).alias("x0"), F.min(F.when(~h & long & (c > F.col("e_x1") - search * wide), c)).alias("x1"),
        F.max(F.when(h & long & (c < F.col("e_y0") + search * high), c)).alias("y0"), F.min(F.when(bottom, c)).alias("low"),
        F.min(F.when(h & (F.col("covered") >= 0.9 * wide) & (c > F.col("e_y1") - 0.2 * high), c)).alias("title"), F.reverse(F.array_sort(F.collect_list(F.when(bottom, c)))).alias("ring"),
    )
    kept = F.aggregate("ring", F.array().cast("array<double>"), lambda s, y: F.when((F.size(s) == 0) | (F.element_at(s, -1) - y > 1.0), F.concat(s, F.array(y))).otherwise(s))
    several = isinstance(policy, (list, tuple))
    p = F.col("policy") if several else policy if isinstance(policy, Column) else F.lit(policy)
    y1 = F.when(p == "title_top", F.coalesce("title", "low")).when(p == "inner_ring", F.coalesce(F.get(kept, 1), F.col("low"))).otherwise(F.col("low"))
    there = F.col("x0").isNotNull() & F.col("x1").isNotNull() & F.col("y0").isNotNull() & F.col("low").isNotNull()
    cols = {"x0": F.col("x0"), "y0": F.col("y0"), "x1": F.col("x1"), "y1": y1}
    out = extents.select(*[c for c in extents.columns if c not in G.SIDES]).join(found, keys, "left")
    if several:
        out = out.withColumn("policy", F.explode(F.array(*[F.lit(n) for n in policy])))
    return out.select(*keys, *(["policy"] if several else []), *[F.when(there, v).alias(k) for k, v in cols.items()], F.when(there, "OK").otherwise("FRAME_NOT_FOUND").alias("status"))


def drawing_items(items: DataFrame, frames: DataFrame, areas: DataFrame, keys: list[str], pad: float = 0.5, edge_min: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(items that are drawing, per path ``keys..., path_id, reason`` of what became of it where that is not all kept).

    ``frames``: ``keys, x0..y1``; ``areas``: ``keys, x0..y1`` of the supplier's title block and tables. In this order:

    * A path beyond the padded frame, or over 0.9 of it long, goes (``frame_band``, ``frame_rule``), but of a path of several
      lines those stay that are level, lie inside, not on the frame's edge, not frame-long, and are no ticks at the edge.
    * A path of lines that is one rule on the frame's edge goes (``frame_edge``).
    * Of a path whose centre lies in an area, if it is several lines, those stay that are level, longer than 2 and end outside
      all areas; else it goes (``area``). An item that ends inside areas with both ends goes too; a path's only line, if both
      ends lie in one area.

    A path that lost some items has the reason with ``_split``. Paths of pages without a frame are left out.

    Items pass once: what is left after a step is a flag, the next step's windows look at flagged items only, and the areas
    of a page, which are few, come as one array.
    """
    pk = [*keys, "path_id"]
    f = frames.select(*keys, *[F.col(s).alias(f"f_{s}") for s in G.SIDES])
    e = with_ends(items).join(f, keys).filter("f_x0 IS NOT NULL")
    per = Window.partitionBy(*pk)
    fw, fh = F.col("f_x1") - F.col("f_x0"), F.col("f_y1") - F.col("f_y0")
    dx, dy = F.abs(F.col("ax") - F.col("bx")), F.abs(F.col("ay") - F.col("by"))
    length = F.sqrt(dx * dx + dy * dy)

    def measured(df: DataFrame, of: Column) -> DataFrame:
        side = lambda c: (F.min if c.endswith("0") else F.max)(F.when(of, F.col(c))).over(per)
        return df.withColumns({**{f"b_{c}": side(c) for c in G.SIDES}, "n": F.count_if(of).over(per), "straight": F.bool_and(F.when(of, F.col("op") == "l")).over(per)})

    e = measured(e, F.lit(True))
    padded = G.pad(G.of("f_"), pad)
    band = ~G.contains(padded, G.of("b_"))
    over = (F.col("b_x1") - F.col("b_x0") > 0.9 * fw) | (F.col("b_y1") - F.col("b_y0") > 0.9 * fh)
    inside = G.holds_point(padded, F.col("ax"), F.col("ay")) & G.holds_point(padded, F.col("bx"), F.col("by"))
    to = lambda v, side: F.abs(F.col(v) - F.col(f"f_{side}"))
    tick = length < 0.03 * F.least(fw, fh)
    flat_ok = (F.least(to("ay", "y0"), to("ay", "y1")) >= 1) & (dx <= 0.9 * fw) & ~((F.least(to("ax", "x0"), to("ax", "x1"), to("bx", "x0"), to("bx", "x1")) < 1) & tick)
    tall_ok = (F.least(to("ax", "x0"), to("ax", "x1")) >= 1) & (dy <= 0.9 * fh) & ~((F.least(to("ay", "y0"), to("ay", "y1"), to("by", "y0"), to("by", "y1")) < 1) & tick)
    rescued = (F.col("n") > 1) & F.col("straight") & inside & F.when(dy < LEVEL, flat_ok).when(dx < LEVEL, tall_ok).otherwise(F.lit(False))
    e = e.withColumns({"why": F.when(band, "frame_band").when(over, "frame_rule"), "stay": F.coalesce(F.when(band | over, rescued).otherwise(F.lit(True)), F.lit(False))})
    e = measured(e, F.col("stay"))
    bw, bh = F.col("b_x1") - F.col("b_x0"), F.col("b_y1") - F.col("b_y0")
    on = lambda a, b: F.least(F.abs(F.col(f"b_{a}") - F.col(f"f_{a}")), F.abs(F.col(f"b_{b}") - F.col(f"f_{b}"))) < 1
    edge = F.col("straight") & (((bh < 0.6) & (bw > edge_min) & on("y0", "y1")) | ((bw < 0.6) & (bh > edge_min) & on("x0", "x1")))
    e = e.withColumns({"edge": F.col("stay") & F.coalesce(edge, F.lit(False)), "kept": F.col("stay") & F.coalesce(~edge, F.lit(False))})
    # which ends and centres lie in an area
    a = areas.groupBy(*keys).agg(F.collect_list(F.struct(*G.SIDES)).alias("areas"))
    e = e.join(a, keys, "left").withColumn("areas", F.coalesce("areas", F.array().cast("array<struct<x0:double,y0:double,x1:double,y1:double>>")))
    point = lambda x, y: F.struct(x.alias("x0"), y.alias("y0"), x.alias("x1"), y.alias("y1"))
    begin, end = point(F.col("ax"), F.col("ay")), point(F.col("bx"), F.col("by"))
    middle = point((F.col("b_x0") + F.col("b_x1")) / 2, (F.col("b_y0") + F.col("b_y1")) / 2)
    held = lambda p: F.coalesce(F.exists("areas", lambda r: G.near(p, r, AREA)), F.lit(False))
    both_in = F.coalesce(F.exists("areas", lambda r: G.near(begin, r, AREA) & G.near(end, r, AREA)), F.lit(False))
    e = e.withColumns({"ends": held(begin).cast("int") + held(end).cast("int"), "one": both_in, "central": held(middle)}).drop("areas")
    out_ok = (F.col("n") > 1) & F.col("straight") & ((dx < LEVEL) | (dy < LEVEL)) & (length > 2) & (F.col("ends") == 0)
    e = e.withColumn("first", F.col("kept") & F.when(F.col("central"), out_ok).otherwise(F.lit(True)))
    left = F.count_if("first").over(per)
    both = F.when(left > 1, F.col("ends") == 2).otherwise((F.col("op") == "l") & F.col("one"))
    e = e.withColumn("drawn", F.col("first") & ~both)
    per_path = e.groupBy(*pk).agg(F.first("why").alias("why"), F.count_if("stay").alias("stayed"), F.count_if("edge").alias("edges"), F.count_if("kept").alias("had"), F.count_if("drawn").alias("left"))
    reasons = F.array(
        F.when(F.col("stayed") > 0, F.concat("why", F.lit("_split"))).otherwise(F.col("why")),
        F.when(F.col("edges") > 0, F.lit("frame_edge")),
        F.when(F.col("left") < F.col("had"), F.when(F.col("left") > 0, "area_split").otherwise("area")),
    )
    return e.filter("drawn").select(*items.columns), per_path.select(*pk, F.explode(F.array_compact(reasons)).alias("reason"))


def page_frame(items: DataFrame, pages: DataFrame, keys: list[str], **options) -> DataFrame:
    """The inner frame of each page of items: strays dropped, extents and segments taken, the policy applied."""
    kept = on_page(boxes(items, keys), pages, keys)
    extents = kept.groupBy(*keys).agg(*[(F.min if s.endswith("0") else F.max)(s).alias(s) for s in G.SIDES])
    segs = segments(items.join(kept.select(*keys, "path_id"), [*keys, "path_id"], "left_semi"), keys)
    return inner_frame(segs, extents, keys, **options)
