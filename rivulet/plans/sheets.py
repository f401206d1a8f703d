"""Queries on title blocks, corner boxes, trimming, and searches for a place or a scale."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions import geometry as G
from rivulet.operators import layout, sheets
from rivulet.sources import views as V
from rivulet.sources.views import with_views

PAGE = ["page_id"]


def _frames(rules):
    return rules.select("page_id").distinct().select("page_id", *[F.lit(v).alias(n) for n, v in zip(G.SIDES, (0.0, 0.0, 800.0, 600.0))])


def title_rows(spark, d):
    r = V.rules(spark, d).select("page_id", "orient", "coord", "lo", "hi")
    return sheets.title_rows(r, _frames(r), PAGE).drop("row_id")


TITLE_SQL = with_views(
    "rule",
    """, h AS (SELECT DISTINCT page_id, lo, hi, coord FROM rule WHERE orient = 'H' AND coord > 300 AND coord < 598),
v AS (SELECT DISTINCT page_id, coord AS v, lo AS v0 FROM rule WHERE orient = 'V' AND hi >= 598.5),
t AS (SELECT * FROM h WHERE EXISTS (SELECT 1 FROM v WHERE v.page_id = h.page_id AND abs(v - lo) < 1.5 AND v0 <= coord + 1.5) AND (abs(hi - 800) < 1.5 OR EXISTS (SELECT 1 FROM v WHERE v.page_id = h.page_id AND abs(v - hi) < 1.5))),
k(page_id, lo, hi, coord) AS (SELECT * FROM t WHERE abs(hi - 800) < 1.5 UNION SELECT t.* FROM k JOIN t ON t.page_id = k.page_id AND (abs(t.hi - k.lo) < 1.5 OR abs(t.lo - k.hi) < 1.5))
SELECT page_id, lo AS x0, coord AS y0, hi AS x1, 600.0::DOUBLE AS y1 FROM k""",
)


def corner_boxes(spark, d):
    r = V.rules(spark, d).select("page_id", "orient", "coord", "lo", "hi")
    return sheets.corner_boxes(r, _frames(r), PAGE)


CORNER_SQL = with_views(
    "rule",
    """, h AS (SELECT DISTINCT page_id, lo, hi, coord, unnest([CASE WHEN abs(lo) <= 1.5 THEN hi END, CASE WHEN abs(hi - 800) <= 1.5 THEN lo END]) AS free FROM rule WHERE orient = 'H' AND hi - lo <= 200),
g AS (SELECT *, unnest([true, false]) AS top FROM h WHERE free IS NOT NULL), k AS (SELECT *, CASE WHEN top THEN coord ELSE 600 - coord END AS deep, CASE WHEN top THEN 0 ELSE 600 END AS edge FROM g)
SELECT DISTINCT page_id, lo AS x0, CASE WHEN top THEN 0 ELSE coord END::DOUBLE AS y0, hi AS x1, CASE WHEN top THEN coord ELSE 600 END::DOUBLE AS y1 FROM k
WHERE deep > 6 AND deep < 90 AND EXISTS (SELECT 1 FROM rule v WHERE v.orient = 'V' AND v.page_id = k.page_id AND abs(v.coord - free) < 1.5 AND v.lo <= least(k.coord, edge) + 1.5 AND v.hi >= greatest(k.coord, edge) - 1.5)""",
)


def corner_fractions(spark, d):
    r = V.rules(spark, d).select("page_id", "orient", "coord", "lo", "hi")
    f = _frames(r)
    return sheets.fractions(sheets.corner_boxes(r, f, PAGE), f, PAGE)


def rule_trim(spark, d):
    r = V.rules(spark, d).withColumn("page_id", F.expr("page_id div 97"))
    return sheets.trim_rules(r, V.furniture(spark, d).withColumnRenamed("furn_id", "area_id"), PAGE, "rule_id")


TRIM_SQL = with_views(
    "rule furn",
    """, r AS (SELECT * REPLACE (page_id // 97 AS page_id) FROM rule),
p AS (SELECT r.*, f.furn_id, CASE WHEN orient = 'H' THEN f.x0 ELSE f.y0 END AS nr, CASE WHEN orient = 'H' THEN f.x1 ELSE f.y1 END AS fa, CASE WHEN orient = 'H' THEN f.y0 ELSE f.x0 END AS c0, CASE WHEN orient = 'H' THEN f.y1 ELSE f.x1 END AS c1 FROM r JOIN furn f USING (page_id)),
q AS (SELECT *, lo BETWEEN nr - 0.6 AND fa + 0.6 AND coord BETWEEN c0 - 0.6 AND c1 + 0.6 AS a, hi BETWEEN nr - 0.6 AND fa + 0.6 AND coord BETWEEN c0 - 0.6 AND c1 + 0.6 AS b FROM p),
n AS (SELECT *, CASE WHEN a THEN CASE WHEN hi < nr THEN nr ELSE fa END ELSE lo END AS n_lo, CASE WHEN a THEN hi ELSE CASE WHEN lo < nr THEN nr ELSE fa END END AS n_hi FROM q WHERE a <> b AND coord > c0 + 0.6 AND (orient = 'H' OR coord < c1 - 0.6)),
k AS (SELECT * FROM n WHERE CASE WHEN a THEN abs(lo - n_lo) ELSE abs(hi - n_hi) END > 1 QUALIFY row_number() OVER (PARTITION BY rule_id, page_id ORDER BY furn_id) = 1)
SELECT r.page_id, r.rule_id, r.orient, r.coord, coalesce(n_lo, r.lo) AS lo, coalesce(n_hi, r.hi) AS hi FROM r LEFT JOIN k USING (page_id, rule_id)""",
)


def path_pieces(spark, d):
    b = V.boxes(spark, d).withColumn("path", F.col("box_id") % 40)
    return sheets.path_pieces(b, PAGE, "path", "box_id", 60.0, 8).withColumnRenamed("v", "box_id")


PIECES_SQL = with_views(
    "box",
    """, b AS (SELECT *, box_id % 40 AS path, count(*) OVER (PARTITION BY page_id, box_id % 40) AS n, min(box_id) OVER (PARTITION BY page_id, box_id % 40) AS least FROM box),
e AS (SELECT a.box_id AS a, b.box_id AS b FROM b a JOIN b ON a.page_id = b.page_id AND a.path = b.path AND a.n >= 8 AND a.x1 + 60 >= b.x0 AND b.x1 + 60 >= a.x0 AND a.y1 + 60 >= b.y0 AND b.y1 + 60 >= a.y0),
r(v, u) AS (SELECT a, b FROM e UNION SELECT r.v, e.b FROM r JOIN e ON r.u = e.a)
SELECT v AS box_id, min(u) AS piece FROM r GROUP BY v UNION ALL SELECT box_id, least FROM b WHERE n < 8""",
)


def first_clear_place(spark, d):
    # a page has few cells and thousands of candidates: by the cells' size alone Spark would leave all pages to one task
    cells = layout.cells(V.boxes(spark, d), PAGE, 16.0).repartition(4 * spark.sparkContext.defaultParallelism, *PAGE)
    k = spark.range(6 * 50 * 35).selectExpr("id", "6 - id div 1750 AS k", "id % 1750 div 35 AS ix0", "id % 35 AS iy0")
    c = cells.select("page_id").distinct().withColumn("__j", F.lit(1)).join(F.broadcast(k.withColumn("__j", F.lit(1))), "__j").drop("__j")
    c = c.withColumns({"ix1": F.col("ix0") + F.col("k") - 1, "iy1": F.col("iy0") + F.col("k") - 1}).filter("ix1 < 50 AND iy1 < 35")
    return sheets.first_clear(cells, c, PAGE, "id")


CLEAR_SQL = with_views(
    "box",
    """, c0 AS (SELECT DISTINCT page_id, unnest(range(CAST(floor(x0 / 16) AS BIGINT), CAST(floor(x1 / 16) AS BIGINT) + 1)) AS ix, y0, y1 FROM box),
c AS (SELECT DISTINCT page_id, ix, unnest(range(CAST(floor(y0 / 16) AS BIGINT), CAST(floor(y1 / 16) AS BIGINT) + 1)) AS iy FROM c0),
k AS (SELECT id, 6 - id // 1750 AS k, id % 1750 // 35 AS ix0, id % 35 AS iy0 FROM (SELECT unnest(range(10500)) AS id)),
t AS (SELECT p.page_id, k.*, ix0 + k - 1 AS ix1, iy0 + k - 1 AS iy1 FROM (SELECT DISTINCT page_id FROM c) p, k WHERE ix0 + k - 1 < 50 AND iy0 + k - 1 < 35)
SELECT page_id, id, k, ix0, iy0, ix1, iy1 FROM t WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.page_id = t.page_id AND c.ix BETWEEN ix0 AND ix1 AND c.iy BETWEEN iy0 AND iy1) QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY id) = 1""",
)


def largest_scale(spark, d):
    b = V.boxes(spark, d).filter("x1 > x0 AND y1 > y0").withColumn("page_id", F.expr("box_id div 20"))
    return sheets.largest_scale(b, PAGE, "box_id", 400.0, 300.0, most=30.0)


def house_scale(spark, d):
    b = V.boxes(spark, d).filter("x1 > x0 AND y1 > y0").withColumn("page_id", F.expr("box_id div 20"))
    return sheets.largest_scale(b, PAGE, "box_id", 300.0, 220.0, least=0.2, most=30.0, corner=(180.0, 120.0))


def label_fields(spark, d):
    b = V.boxes(spark, d).selectExpr("box_id div 20 AS page_id", "box_id AS word_id", "x0", "y0", "x1 + 4 AS x1", "y1 + 4 AS y1", "concat(CASE WHEN box_id % 3 = 0 THEN 'Model: ' WHEN box_id % 3 = 1 THEN 'Unit: ' ELSE '' END, CAST(box_id AS STRING)) AS text")
    lines = V.rules(spark, d).selectExpr("page_id div 5 AS page_id", "orient", "coord", "lo", "hi")
    labels = spark.createDataFrame([("model", "Model"), ("unit", "Unit"), ("sheet", "Sheet")], "field string, label string")
    return sheets.label_fields(b, lines, labels, PAGE)


QUERIES = {
    "title_rows": (title_rows, TITLE_SQL), "corner_boxes": (corner_boxes, CORNER_SQL), "corner_fractions": (corner_fractions, None), "rule_trim": (rule_trim, TRIM_SQL),
    "path_pieces": (path_pieces, PIECES_SQL), "first_clear_place": (first_clear_place, CLEAR_SQL), "largest_scale": (largest_scale, None), "house_scale": (house_scale, None), "label_fields": (label_fields, None),
}
