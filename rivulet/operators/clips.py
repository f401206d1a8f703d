"""Clips of blocks: blocks whose ink interleaves become one, and each block's rectangle loses what is not its own.

Members (``keys, block, prim_id, x0, y0, x1, y1, rule``) are a block's drawn pieces; ``rule`` marks straight rules, which
two blocks may share. Furniture (the same without ``block``) belongs to no block. Pages give ``keys, x0, y0, x1, y1`` and
the frame's inner rectangle ``i_x0, i_y0, i_x1, i_y1``.

Plan. Pieces meet in range joins by grid cells. Whether two blocks interleave depends on their pieces alone, so merging
them never ends another pair: the fixpoint of merge and start again is the closure of one join, taken as components,
whatever the number of merges. Rectangle algebra is folds over the cutters of one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions import geometry as G
from rivulet.operators import graph, joins

# Reach of a piece, margin of a clip, margin of a cut, of the frame; ink counts this far inside a piece.
TOUCH, MARGIN, AROUND, FRAME, EDGE = 0.2, 0.6, 0.35, 0.7, 0.5
THIN, MANY, BOUND = 1.2, 24, 200


def overlaps(a: Column, b: Column) -> Column:
    """A common area, not only a common edge."""
    i = G.meet(a, b)
    return (G.width(i) > 0) & (G.height(i) > 0)


def merge_interleaved(members: DataFrame, keys: list[str], bound: int = BOUND) -> tuple[DataFrame, DataFrame]:
    """(members with the least block of those they interleave with, per key ``merges`` and ``beyond``).

    Blocks interleave where a piece that is no rule comes within ``TOUCH`` of a piece of another block. ``beyond`` tells
    where a search that starts again after every merge would have given up after ``bound`` starts; here it is complete.
    """
    p = members.select(*keys, "block", "prim_id", "rule", *G.SIDES)
    met = joins.box_join(p, p.filter(~F.col("rule")), keys, TOUCH).filter((F.col("a_block") != F.col("b_block")) & overlaps(G.pad(G.of("a_"), TOUCH), G.of("b_")))
    name = lambda c: F.struct(*keys, F.col(c).alias("block"))
    vertices = members.select(name("block").alias("v")).distinct()
    comps = graph.components(vertices, met.select(name("a_block").alias("a"), name("b_block").alias("b")).distinct())
    to = comps.select(*[F.col(f"v.{k}").alias(k) for k in keys], F.col("v.block").alias("block"), F.col("comp.block").alias("__to"))
    report = to.groupBy(*keys).agg((F.count(F.lit(1)) - F.countDistinct("__to")).alias("merges")).withColumn("beyond", F.col("merges") >= bound)
    return members.join(to, [*keys, "block"]).withColumn("block", F.col("__to")).drop("__to"), report


def _absorbed(pieces: Column, cuts: Column, ink) -> Column:
    """Pieces without ink inside go into a neighbour, while one is there whose hull with it meets no cut and no other piece."""
    common = lambda a, b: G.area(G.meet(a, b)) > 1e-6
    made = "array<struct<i:int,j:int,g:struct<x0:double,y0:double,x1:double,y1:double>>>"

    def once(ps: Column) -> Column:
        def partner(k: Column, i: Column) -> Column:
            def of(q: Column, j: Column) -> Column:
                g = G.hull(q, k)
                free = ~F.exists(cuts, lambda x: common(g, x)) & ~F.exists(F.filter(ps, lambda o, n: (n != i) & (n != j)), lambda o: common(g, o))
                return F.when((i != j) & free, F.struct(i.alias("i"), j.alias("j"), g.alias("g")))

            return F.when(ink(k), F.array().cast(made)).otherwise(F.filter(F.transform(ps, of), lambda x: x.isNotNull()))

        first = F.get(F.flatten(F.transform(ps, partner)), 0)
        new = F.transform(F.array(first), lambda t: F.when(t.isNull(), ps).otherwise(F.concat(F.filter(ps, lambda o, n: (n != t["i"]) & (n != t["j"])), F.array(t["g"]))))
        return F.get(new, 0)

    return F.when(F.size(pieces) <= 1, pieces).otherwise(F.aggregate(F.sequence(F.lit(2), F.size(pieces)), pieces, lambda ps, _: once(ps)))


def block_clips(members: DataFrame, furniture: DataFrame, pages: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., block, clips, flags`` of blocks that no longer interleave: their rectangles without foreign pieces.

    A foreign piece inside a block's rectangle is cut out with a margin, unless it touches the block's own ink: then a rule
    is shared, and other furniture is flagged. Pieces that hold none of the block's ink go (all going: the rectangle stays
    whole), those with ink at their edges only join a neighbour, and what runs into the frame's band is cut off if that
    loses nothing but rules. Flags: ``SHARES_RULE_WITH_FURNITURE, INTERLEAVES_FURNITURE, FRAGMENTED_CLIP,
    BLOCK_ENTERS_FRAME_BAND``.
    """
    bk = [*keys, "block"]
    own = members.groupBy(*bk).agg(
        F.collect_list(F.struct(G.of().alias("r"), "rule")).alias("own"), *[(F.min if n.endswith("0") else F.max)(n).alias(f"b_{n}") for n in G.SIDES]
    )
    page = pages.select(*keys, G.of().alias("page"), G.of("i_").alias("inner"))
    blocks = own.join(page, keys).withColumn("clip", G.meet(G.pad(G.of("b_"), MARGIN), F.col("page")))
    blocks = graph.written(blocks.filter((G.width(F.col("clip")) > 0) & (G.height(F.col("clip")) > 0)).drop(*[f"b_{n}" for n in G.SIDES], "page"))
    every = members.select(*keys, F.col("block").alias("owner"), "prim_id", "rule", *G.SIDES).unionByName(furniture.select(*keys, F.lit(None).alias("owner"), "prim_id", "rule", *G.SIDES))
    foreign = joins.box_join(blocks.select(*bk, "clip.*"), every, keys).filter((F.col("b_owner").isNull() | (F.col("b_owner") != F.col("a_block"))) & overlaps(G.of("a_"), G.of("b_")))
    foreign = foreign.select(*keys, F.col("a_block").alias("block"), F.col("b_owner").isNull().alias("furn"), F.col("b_prim_id").alias("prim_id"), F.col("b_rule").alias("rule"), G.of("b_").alias("r"))
    touching = joins.box_join(members.select(*bk, *G.SIDES), every.select(*keys, "owner", "prim_id", *G.SIDES), keys, TOUCH)
    touching = touching.filter((F.col("b_owner").isNull() | (F.col("b_owner") != F.col("a_block"))) & overlaps(G.pad(G.of("a_"), TOUCH), G.of("b_")))
    touching = touching.select(*keys, F.col("a_block").alias("block"), F.col("b_owner").isNull().alias("furn"), F.col("b_prim_id").alias("prim_id"), F.lit(True).alias("hit")).distinct()
    seen = foreign.join(touching, [*bk, "furn", "prim_id"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    cut = seen.groupBy(*bk).agg(
        F.array_sort(F.collect_list(F.when(~F.col("hit"), F.struct("furn", "prim_id", G.pad(F.col("r"), AROUND).alias("r"))))).alias("cuts"),
        F.max(F.col("hit") & F.col("furn") & F.col("rule")).alias("shares"),
        F.max(F.col("hit") & F.col("furn") & ~F.col("rule")).alias("mixes"),
    )
    rects = F.array().cast("array<struct<x0:double,y0:double,x1:double,y1:double>>")
    b = blocks.join(cut, bk, "left").withColumn("cuts", F.coalesce(F.transform("cuts", lambda c: c["r"]), rects))
    mine = lambda k: F.exists("own", lambda m: overlaps(k, m["r"]))
    ink = lambda k: mine(G.pad(k, -EDGE))
    b = b.withColumn("ps", G.subtract_all(F.array("clip"), F.col("cuts")))
    b = b.withColumn("ps", F.filter("ps", mine))
    b = graph.written(b.withColumn("ps", F.when(F.size("ps") == 0, F.array("clip")).otherwise(F.col("ps"))))
    b = graph.written(b.withColumn("ps", _absorbed(F.col("ps"), F.col("cuts"), ink)))
    lim = G.pad(F.col("inner"), FRAME)
    small = lambda k: (G.width(k) <= THIN) | (G.height(k) <= THIN) | ~ink(k)
    beyond = F.exists("ps", lambda k: ~G.contains(lim, k))
    kept = F.filter(F.transform("ps", lambda k: G.meet(k, lim)), lambda k: ~small(k))
    lost = F.exists("own", lambda m: ~m["rule"] & ~G.contains(lim, m["r"]) & F.exists("ps", lambda k: overlaps(k, m["r"])))
    left_out = F.exists(F.filter("ps", lambda k: small(G.meet(k, lim))), lambda k: F.exists("own", lambda m: overlaps(G.meet(k, F.col("inner")), m["r"])))
    b = b.withColumns({"beyond": beyond, "kept": kept, "stays": lost | left_out, "many": F.size("ps") > MANY})
    cuts_frame = F.col("beyond") & (F.size("kept") > 0) & ~F.col("stays")
    flag = lambda c, name: F.when(F.coalesce(c, F.lit(False)), F.lit(name))
    flags = F.array_compact(
        F.array(flag(F.col("shares"), "SHARES_RULE_WITH_FURNITURE"), flag(F.col("mixes"), "INTERLEAVES_FURNITURE"), flag(F.col("many"), "FRAGMENTED_CLIP"), flag(F.col("beyond") & ~cuts_frame, "BLOCK_ENTERS_FRAME_BAND"))
    )
    return b.select(*bk, F.when(cuts_frame, F.col("kept")).otherwise(F.col("ps")).alias("clips"), flags.alias("flags"))
