"""Rules of a house sheet: what goes to the right column, how it stacks, and whether all placements keep the sheet's rules.

Members (``keys, block, prim_id, x0, y0, x1, y1, rule``; ``rule``: a level line) make up blocks; ``content`` gives the content
box of a page (``keys, x0, y0, x1, y1``). Blocks are few a page; what is decided over several of them goes in rounds of joins
on the page, and stacking is one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions import geometry as G
from rivulet.operators import graph, joins

# Share of a block's width that makes a rule, rules of a table, size and share of text, height of a text line,
# reach of touching blocks, height and overlap of a caption and its distance, space between stacked blocks, slack of a unit.
FULL, TABLE, SMALL, MOSTLY, LINE = 0.6, 4, 0.02, 0.95, 0.04
TOUCH, CAPTION, OVER, BELOW, SPACE, UNIT = 0.01, 0.08, 0.5, 0.1, 8.0, 2.0


def block_facts(members: DataFrame, content: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., block, x0, y0, x1, y1, rules, table, textual``: boxes of blocks and what they are.

    A rule counts if it spans over 0.6 of its block's width; four make a table. A block is textual if it is a table, if 95 % of
    its members are under 2 % of the content's width, or if none is taller than 4 % of the content's height.
    """
    side = lambda c: (F.min if c.endswith("0") else F.max)(c).alias(c)
    box = members.groupBy(*keys, "block").agg(*[side(c) for c in G.SIDES])
    c = content.select(*keys, (F.col("x1") - F.col("x0")).alias("cw"), (F.col("y1") - F.col("y0")).alias("ch"))
    wide = box.select(*keys, "block", (F.col("x1") - F.col("x0")).alias("bw"))
    m = members.join(wide, [*keys, "block"]).join(c, keys)
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    facts = m.groupBy(*keys, "block").agg(
        F.count_if(F.col("rule") & (w > FULL * F.col("bw"))).alias("rules"), F.avg((F.greatest(w, h) < SMALL * F.col("cw")).cast("int")).alias("small"), F.max(h > LINE * F.col("ch")).alias("tall")
    )
    table = F.col("rules") >= TABLE
    return box.join(facts, [*keys, "block"]).select(*keys, "block", *G.SIDES, "rules", table.alias("table"), (table | (F.col("small") >= MOSTLY) | ~F.col("tall")).alias("textual"))


def column_blocks(members: DataFrame, rail: DataFrame, content: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., block, stays`` of the blocks found in the right column: tables and notes stay, drawings go back to the views.

    ``rail``: ``keys, block, in_rail`` for all blocks. What is not textual goes back; so does, in rounds, what touches (within
    1 % of the content's width) a view or a block that goes back, or a drawing would be torn; and a low block without a table's
    rules under or over one that goes back, its caption: overlapping half of the narrower width, at most 10 % of the content's
    height away. If all would go back, or none does, all stay.
    """
    c = content.select(*keys, (F.col("x1") - F.col("x0")).alias("cw"), (F.col("y1") - F.col("y0")).alias("ch"))
    facts = graph.written(block_facts(members, content, keys).join(rail, [*keys, "block"]).join(c, keys))
    boxes = facts.select(*keys, "block", "in_rail", *[F.col(s) for s in G.SIDES], "cw")
    near = joins.box_join(boxes.filter("in_rail"), boxes, keys, 64.0).filter("a_block <> b_block")
    near = near.filter(overlaps(G.pad(G.of("a_"), F.col("a_cw") * TOUCH), G.of("b_"))).select(*keys, F.col("a_block").alias("block"), F.col("b_block").alias("other"))
    near = graph.written(near)
    back = graph.written(facts.filter(~F.col("in_rail") | ~F.col("textual")).select(*keys, "block"))
    while True:
        more = near.join(back.withColumnRenamed("block", "other"), [*keys, "other"], "left_semi").select(*keys, "block").distinct().join(back, [*keys, "block"], "left_anti")
        more = graph.written(more)
        if not more.limit(1).count():
            break
        back = graph.written(back.unionByName(more))
    gone = facts.join(back, [*keys, "block"], "left_semi").filter("in_rail").select(*keys, *[F.col(s).alias(f"g_{s}") for s in G.SIDES])
    low = facts.filter("in_rail").join(back, [*keys, "block"], "left_anti").filter((F.col("rules") < TABLE) & (F.col("y1") - F.col("y0") < CAPTION * F.col("ch")))
    pair = low.join(gone, keys)  # blocks of one page's column
    common = F.least("x1", "g_x1") - F.greatest("x0", "g_x0")
    apart = F.greatest(F.col("y0") - F.col("g_y1"), F.col("g_y0") - F.col("y1"))
    captions = pair.filter((common >= OVER * F.least(F.col("x1") - F.col("x0"), F.col("g_x1") - F.col("g_x0"))) & (apart >= -UNIT) & (apart <= BELOW * F.col("ch"))).select(*keys, "block").distinct()
    all_back = back.unionByName(captions).distinct().withColumn("back", F.lit(True))
    out = facts.filter("in_rail").select(*keys, "block").join(all_back, [*keys, "block"], "left").withColumn("back", F.coalesce("back", F.lit(False)))
    some = F.bool_and("back").over(Window.partitionBy(*keys))
    return out.select(*keys, "block", (~F.col("back") | some).alias("stays"))


def overlaps(a: Column, b: Column) -> Column:
    i = G.meet(a, b)
    return (G.width(i) > 0) & (G.height(i) > 0)


def stacked(blocks: DataFrame, columns: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., unit, place, scale, x, y`` of the blocks of a right column, one under another at one scale.

    ``blocks``: ``keys, block, x0, y0, x1, y1, table, pulled``; ``columns``: ``keys, c_x0, c_y0, c_x1, c_y1`` (the column, as wide
    as it may get) and ``most``, a bound on the scale or null. Blocks whose boxes meet are one unit, again and again as boxes
    grow. Pulled units stand first, then tables, each from the top; all are set to the right edge. ``x, y`` is the upper left
    corner of a unit, and ``scale`` the greatest at which the widest fits the width and all with their spaces the height.
    """
    named = blocks.select(*keys, F.struct(*keys, "block").alias("__b"), *G.SIDES)  # ids of different pages may be equal
    units = graph.merge_overlapping(named, keys, "__b", 0.0).withColumn("unit", F.col("block.block")).drop("block")
    kinds = joins.inside(blocks, units, keys, 0.0).filter(G.contains(G.of("b_"), G.of("a_")))
    kinds = kinds.groupBy(*keys, F.col("b_unit").alias("unit")).agg(F.max("a_table").alias("table"), F.max("a_pulled").alias("pulled"))
    u = units.join(kinds, [*keys, "unit"]).withColumns({"w": F.col("x1") - F.col("x0"), "h": F.col("y1") - F.col("y0")})
    per = Window.partitionBy(*keys)
    order = per.orderBy(F.desc("pulled"), F.desc("table"), "y0", "unit")
    u = u.withColumns({"wide": F.max("w").over(per), "high": F.sum("h").over(per), "n": F.count(F.lit(1)).over(per), "place": F.row_number().over(order), "above": F.coalesce(F.sum("h").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))})
    u = u.join(columns, keys)
    fit = F.least((F.col("c_x1") - F.col("c_x0")) / F.col("wide"), (F.col("c_y1") - F.col("c_y0")) / (F.col("high") + SPACE * (F.col("n") - 1)))
    u = u.withColumn("scale", F.least(fit, F.coalesce("most", fit)))
    return u.select(*keys, "unit", "place", "scale", (F.col("c_x1") - F.col("w") * F.col("scale")).alias("x"), (F.col("c_y0") + F.col("above") * F.col("scale") + SPACE * (F.col("place") - 1)).alias("y"))


def pulled(members: DataFrame, pulls: DataFrame, frames: DataFrame, keys: list[str]) -> DataFrame:
    """Members with ``pull``: the first area that holds them whole, null for none; lines without width count as well.

    ``pulls``: ``keys, pull, x0, y0, x1, y1`` as fractions of the frame. A block may be torn; what is pulled is a block of its own.
    """
    f = frames.select(*keys, *[F.col(s).alias(f"f_{s}") for s in G.SIDES])
    at = lambda s: F.col(f"f_{s[0]}0") + F.col(s) * (F.col(f"f_{s[0]}1") - F.col(f"f_{s[0]}0"))
    areas = pulls.join(f, keys).select(*keys, "pull", *[at(s).alias(s) for s in G.SIDES])
    hit = joins.inside(members.select(*keys, "prim_id", *G.SIDES), areas, keys, 0.0).groupBy(*keys, F.col("a_prim_id").alias("prim_id")).agg(F.min("b_pull").alias("pull"))
    return members.join(hit, [*keys, "prim_id"], "left")


#: Fixed values of the house sheet: its frame, where tables and specifications stand, slack of a header.
SHEET = {"page": (842.0, 595.0), "right": 0.62, "upper": 0.4, "middle": 0.30, "header": (1.0, 2.0)}


def placement_findings(places: DataFrame, ink: DataFrame, sheets: DataFrame, cells: DataFrame, headers: DataFrame, keys: list[str]) -> DataFrame:
    """What is wrong with a sheet's placements: ``keys, place_id, other, finding``; no row: nothing.

    ``places``: ``keys, place_id, kind`` and the boxes ``s_*`` in the source and ``x0..y1`` on the sheet. ``ink``: ``keys, place_id,
    x0..y1``, a placement's drawn pieces on the sheet. ``sheets``: ``keys, p_*`` (source page) and ``f_*`` (frame). ``cells``: ``keys,
    cell, x0..y1``: ``projection`` and ``tolerance``, which hold such placements whole, and ``reserved`` ones that no other ink
    may enter. ``headers``: ``keys, header_id, x0..y1``.

    Findings: ``source outside page, outside frame, not in its cell, enters reserved cell, overlaps`` (ink of two placements),
    ``table not top right, performance not right middle, performance not below table, header outside frame, header adjoins no
    table, header covers ink``. Ink meets cells, headers and other ink in range joins.
    """
    f = sheets.select(*keys, *[F.col(f"p_{s}") for s in G.SIDES], *[F.col(f"f_{s}") for s in G.SIDES])
    p = places.join(f, keys)
    own = cells.filter("cell <> 'reserved'").select(*keys, F.col("cell").alias("kind"), G.of().alias("own"))
    p = p.join(own, [*keys, "kind"], "left")
    w, h = SHEET["page"]
    tell = lambda c, text: F.when(F.coalesce(c, F.lit(False)), F.lit(text))
    right = F.col("x0") >= w * SHEET["right"]
    alone = F.array_compact(
        F.array(
            tell(~G.contains(G.of("p_"), G.of("s_")), "source outside page"), tell(~G.contains(G.of("f_"), G.of()), "outside frame"),
            tell(F.col("kind").isin("projection", "tolerance") & ~G.contains(F.col("own"), G.of()), "not in its cell"),
            tell((F.col("kind") == "table") & ~(right & (F.col("y0") < h * SHEET["upper"])), "table not top right"),
            tell((F.col("kind") == "performance") & ~(right & (F.col("y0") >= h * SHEET["middle"])), "performance not right middle"),
        )
    )
    none = F.lit(None).cast(dict(places.dtypes)["place_id"])
    rows = p.select(*keys, "place_id", none.alias("other"), F.explode(alone).alias("finding"))
    kinds = places.select(*keys, "place_id", "kind")
    drawn = ink.select(*keys, "place_id", *G.SIDES).join(kinds, [*keys, "place_id"])
    in_cell = joins.box_join(drawn.filter(~F.col("kind").isin("projection", "tolerance")), cells.filter("cell = 'reserved'").select(*keys, *G.SIDES), keys).filter(overlaps(G.of("a_"), G.of("b_")))
    rows = rows.unionByName(in_cell.select(*keys, F.col("a_place_id").alias("place_id"), none.alias("other"), F.lit("enters reserved cell").alias("finding")).distinct())
    both = joins.box_join(drawn.drop("kind"), drawn.drop("kind"), keys).filter((F.col("a_place_id") < F.col("b_place_id")) & overlaps(G.of("a_"), G.of("b_")))
    rows = rows.unionByName(both.select(*keys, F.col("a_place_id").alias("place_id"), F.col("b_place_id").alias("other"), F.lit("overlaps").alias("finding")).distinct())
    lowest = places.filter("kind = 'table'").groupBy(*keys).agg(F.max("y1").alias("low"))
    under = places.filter("kind = 'performance'").groupBy(*keys).agg(F.min("y0").alias("top")).join(lowest, keys).filter("low >= top")
    rows = rows.unionByName(under.select(*keys, none.alias("place_id"), none.alias("other"), F.lit("performance not below table").alias("finding")))
    hd = headers.join(f, keys)
    out = hd.filter(~G.contains(G.of("f_"), G.of())).select(*keys, F.col("header_id").alias("place_id"), none.alias("other"), F.lit("header outside frame").alias("finding"))
    near, slack = SHEET["header"]
    tables = places.filter("kind = 'table'").select(*keys, "place_id", *[F.col(s).alias(f"t_{s}") for s in G.SIDES])
    adjoin = headers.join(tables, keys).filter((F.abs(F.col("y1") - F.col("t_y0")) <= near) & (F.col("x0") >= F.col("t_x0") - slack) & (F.col("x1") <= F.col("t_x1") + slack))
    adjoin = adjoin.select(*keys, "header_id", "place_id")
    lone = headers.join(adjoin, [*keys, "header_id"], "left_anti").select(*keys, F.col("header_id").alias("place_id"), none.alias("other"), F.lit("header adjoins no table").alias("finding"))
    covers = joins.box_join(headers.select(*keys, "header_id", *G.SIDES), drawn.drop("kind"), keys).filter(overlaps(G.of("a_"), G.of("b_")))
    covers = covers.select(*keys, F.col("a_header_id").alias("header_id"), F.col("b_place_id").alias("place_id")).distinct().join(adjoin, [*keys, "header_id", "place_id"], "left_anti")
    covers = covers.select(*keys, F.col("header_id").alias("place_id"), F.col("place_id").alias("other"), F.lit("header covers ink").alias("finding"))
    return rows.unionByName(out).unionByName(lone).unionByName(covers)
