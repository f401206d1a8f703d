"""Reading order of boxes, and pieces of text that stand on one line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.joins import shuffled


def reading_order(boxes: DataFrame, keys: list[str], id_: str, share: float = 0.3) -> DataFrame:
    """``keys..., id, row, place``: boxes in rows from the top, left to right inside a row, ``place`` over all rows.

    Boxes come by their upper edge (ties by id). Each joins the first row that holds a box it overlaps, in height, by more
    than ``share`` of the lower of the two, else it begins a row; so a row's extent grows with its members, and a box may
    join a row above one it overlaps as well. Boxes without height join none.

    Boxes of one row are chained by overlaps, so groups are cut first where no box crosses (a window), and the ordered
    fold sees only one such island: its array is bounded by what is drawn in one band of a page.
    """
    b = boxes.select(*keys, id_, "x0", F.col("y0").cast("double").alias("y0"), F.col("y1").cast("double").alias("y1")).filter("y0 IS NOT NULL AND y1 IS NOT NULL")
    by_top = Window.partitionBy(*keys).orderBy("y0", id_)
    reach = F.max("y1").over(by_top.rowsBetween(Window.unboundedPreceding, -1))
    cut = b.withColumn("__new", (reach.isNull() | (F.col("y0") >= reach)).cast("int"))
    cut = cut.withColumn("__band", F.sum("__new").over(by_top.rowsBetween(Window.unboundedPreceding, 0)))
    item = F.struct("y0", id_, "y1", "x0")
    rows0 = F.array().cast("array<array<struct<y0:double,y1:double>>>")
    start = F.struct(rows0.alias("rows"), F.array().cast("array<int>").alias("of"))

    def over(a: Column, c: Column) -> Column:
        return F.least(a["y1"], c["y1"]) - F.greatest(a["y0"], c["y0"]) > share * F.least(a["y1"] - a["y0"], c["y1"] - c["y0"])

    def step(s: Column, c: Column) -> Column:
        me = F.struct(c["y0"].alias("y0"), c["y1"].alias("y1"))
        at = F.array_position(F.transform(s["rows"], lambda r: F.exists(r, lambda a: over(a, me))), F.lit(True)).cast("int")
        joined = F.transform(s["rows"], lambda r, i: F.when(i == at - 1, F.concat(r, F.array(me))).otherwise(r))
        return F.struct(
            F.when(at > 0, joined).otherwise(F.concat(s["rows"], F.array(F.array(me)))).alias("rows"),
            F.concat(s["of"], F.array(F.when(at > 0, at).otherwise(F.size(s["rows"]) + 1))).alias("of"),
        )

    one = cut.groupBy(*keys, "__band").agg(F.array_sort(F.collect_list(item)).alias("__b"))
    one = one.withColumn("__of", F.aggregate("__b", start, step, lambda s: s["of"]))
    flat = one.select(*keys, "__band", F.inline(F.arrays_zip("__b", "__of"))).select(*keys, "__band", "__of", "__b.*")
    order = Window.partitionBy(*keys).orderBy("__band", "__of")
    return flat.select(*keys, id_, F.dense_rank().over(order).alias("row"), F.row_number().over(order.orderBy("__band", "__of", "x0", "y0", id_)).alias("place"))


def line_neighbours(spans: DataFrame, keys: list[str], id_: str, near: float = 0.3, alike: float = 0.5, apart: float = 3.0, over: float = 1.0) -> DataFrame:
    """Pairs of spans on one line: ``keys..., a_id, b_id, gap`` with ``a`` before ``b`` in reading order.

    ``spans``: ``keys, id, x0, y0, x1, y1, size``. Centres lie within ``near`` sizes of ``a`` in height, sizes differ by less
    than ``alike``, and ``b`` begins between ``over`` before and ``apart`` sizes behind the end of ``a``. Order: centres
    rounded (half to even), then left edge, then id.

    The reach follows each span's own size, so one cell size would be too coarse for small text and too fine for large.
    Spans fall into size classes of powers of two; ``a`` lies in one cell of its class, sized for the class, and ``b`` asks
    in the few cells around it of the classes its partners can be in. An equi-join, each pair met once.
    """
    size = F.col("size").cast("double")
    s = spans.filter(size > 0).select(*keys, id_, "x0", "x1", size.alias("size"), ((F.col("y0") + F.col("y1")) / 2).alias("cy"))
    class_of = lambda z: F.floor(F.log2(F.greatest(z, F.lit(1.0)))).cast("int")
    tall, wide = (k * F.pow(F.lit(2.0), F.col("__c") + 1) for k in (near, apart))
    a = s.withColumn("__c", class_of(F.col("size"))).withColumns({"__y": F.floor(F.col("cy") / tall), "__x": F.floor(F.col("x1") / wide)})
    a = a.select(*keys, "__c", "__y", "__x", *[F.col(c).alias(f"a_{c}") for c in (id_, "x0", "x1", "size", "cy")])
    b = s.withColumn("__c", F.explode(F.array_distinct(F.array(class_of(F.col("size") - alike), class_of(F.col("size")), class_of(F.col("size") + alike)))))
    b = b.withColumn("__y", F.explode(F.array(*[F.floor(F.col("cy") / tall) + d for d in (-1, 0, 1)])))
    b = b.withColumn("__x", F.explode(F.sequence(F.floor((F.col("x0") - wide) / wide), F.floor((F.col("x0") + over) / wide))))
    b = b.select(*keys, "__c", "__y", "__x", *[F.col(c).alias(f"b_{c}") for c in (id_, "x0", "size", "cy")])
    gap = F.col("b_x0") - F.col("a_x1")
    rank = lambda p: F.struct(F.rint(F.col(f"{p}_cy")), F.col(f"{p}_x0"), F.col(f"{p}_{id_}"))
    met = a.join(shuffled(b), [*keys, "__c", "__y", "__x"]).filter(
        (F.abs(F.col("a_cy") - F.col("b_cy")) < near * F.col("a_size")) & (F.abs(F.col("a_size") - F.col("b_size")) < alike) & (gap > -over) & (gap < apart * F.col("a_size")) & (rank("a") < rank("b"))
    )
    return met.select(*keys, f"a_{id_}", f"b_{id_}", gap.alias("gap"))


def split_lines(spans: DataFrame, keys: list[str], id_: str, group: str, **kw) -> DataFrame:
    """``line_neighbours`` whose pieces travel in different groups: ``keys..., a_id, b_id, a_group, b_group``."""
    g = lambda p: spans.filter(F.col(group).isNotNull()).select(*keys, F.col(id_).alias(f"{p}_{id_}"), F.col(group).alias(f"{p}_{group}"))
    pairs = line_neighbours(spans, keys, id_, **kw).join(shuffled(g("a")), [*keys, f"a_{id_}"]).join(shuffled(g("b")), [*keys, f"b_{id_}"])
    return pairs.filter(F.col(f"a_{group}") != F.col(f"b_{group}")).select(*keys, f"a_{id_}", f"b_{id_}", f"a_{group}", f"b_{group}")
