"""Queries on segments, boxes and fingerprints."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions import bits
from rivulet.functions import geometry as G
from rivulet.operators import blocks, frames, graph, intervals, joins, layout, matching
from rivulet.sources import views as V
from rivulet.sources.views import with_views

PAGE = ["page_id"]
ORIENT = ["page_id", "orient"]


# -- matching -------------------------------------------------------------------------------------------------------
_DIL = """, fw AS (SELECT *, list_transform(grid, lambda r: r | ((r << 1) & 255) | (r >> 7) | (r >> 1) | ((r & 1) << 7)) AS w FROM fp),
fd AS (SELECT *, list_transform(range(8), lambda i: w[i + 1] | w[(i + 7) % 8 + 1] | w[(i + 1) % 8 + 1]) AS d FROM fw)"""
_SCORE = """least(list_sum(list_transform(range(1, 9), lambda i: bit_count(p.grid[i] & s.d[i]))) / greatest(1, list_sum(list_transform(p.grid, lambda x: bit_count(x)))),
  list_sum(list_transform(range(1, 9), lambda i: bit_count(s.grid[i] & p.d[i]))) / greatest(1, list_sum(list_transform(s.grid, lambda x: bit_count(x)))))"""
_BEST = (
    _DIL
    + f""", sc AS (SELECT p.id, s.template, s.rotate, s.search, {_SCORE} AS score FROM fd p JOIN fd s ON p.search = s.search AND p.id <> s.id),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, template ORDER BY score DESC, rotate DESC, search DESC) AS r FROM sc) WHERE r = 1),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, template ORDER BY score DESC, search DESC) AS r FROM sc WHERE rotate = 0) WHERE r = 1),
pk AS (SELECT b.id, b.template, CASE WHEN b.score - u.score < 0.01 THEN 0 ELSE b.rotate END AS rotate, CASE WHEN b.score - u.score < 0.01 THEN u.search ELSE b.search END AS search,
  CASE WHEN b.score - u.score < 0.01 THEN u.score ELSE b.score END AS score,
  row_number() OVER (PARTITION BY b.id ORDER BY b.score DESC, b.rotate DESC, b.template DESC, b.search DESC) AS rank, b.score AS top, b.template AS t
  FROM b LEFT JOIN u ON b.id = u.id AND b.template = u.template)"""
)
MATCH_SQL = with_views(
    "fp",
    _BEST
    + """ SELECT fp.id, CASE WHEN x.score IS NULL THEN 'NO_FRAME' WHEN x.score >= 0.9 AND x.score - coalesce(y.top, 0) >= 0.03 THEN 'OK' WHEN x.score >= 0.9 THEN 'AMBIGUOUS' ELSE 'UNKNOWN_FRAME' END AS status,
 x.template, x.rotate, x.search, x.score, y.t AS runner_up, coalesce(y.top, 0)::DOUBLE AS runner_up_score
 FROM fp LEFT JOIN pk x ON fp.id = x.id AND x.rank = 1 LEFT JOIN pk y ON fp.id = y.id AND y.rank = 2""",
)
TOP3_SQL = with_views("fp", _BEST + " SELECT id, rank::INTEGER AS rank, template, rotate, search, score FROM pk WHERE rank <= 3")


def match_status(spark, d):
    fp = V.fingerprints(spark, d)
    return matching.match_status(fp, fp)


def match_top3_templates(spark, d):
    fp = V.fingerprints(spark, d)
    return matching.top_templates(fp, fp, 3)


def dilate(spark, d):
    g = V.fingerprints(spark, d)
    wide = bits.dilate(F.col("grid"), 8)
    return g.select("id", bits.count(F.col("grid")).alias("cells"), bits.count(wide).alias("wide"), F.array_join(wide, ",").alias("rows"))


DILATE_SQL = with_views("fp", _DIL + " SELECT id, list_sum(list_transform(grid, lambda x: bit_count(x)))::INTEGER AS cells, list_sum(list_transform(d, lambda x: bit_count(x)))::INTEGER AS wide, array_to_string(d, ',') AS rows FROM fd")


def pair_similarity(spark, d):
    return matching.pair_similarity(V.fingerprints(spark, d), 0.75)


PAIR_SQL = with_views("fp", _DIL + f" SELECT p.id AS a, s.id AS b, {_SCORE} AS sim FROM fd p JOIN fd s ON p.search = s.search AND p.id < s.id WHERE {_SCORE} >= 0.75")


def star_cluster(spark, d):
    fp = V.fingerprints(spark, d)
    return matching.star_cluster_table(fp, 0.8)


# -- intervals ------------------------------------------------------------------------------------------------------
_COLL = """, s0 AS (SELECT *, CAST(round_even(coord / 0.4, 0) AS BIGINT) AS bin FROM seg),
s1 AS (SELECT *, max(hi) OVER (PARTITION BY page_id, orient, bin ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s0),
rules AS (SELECT page_id, orient, bin, min(lo) AS lo, max(hi) AS hi, avg(coord) AS coord, sum(greatest(0, hi - greatest(lo, coalesce(reach, lo)))) AS covered FROM s1 GROUP BY ALL)"""


def collinear_rules(spark, d):
    out = intervals.collinear(V.page_segments(spark, d), ORIENT, 400)
    return out.withColumn("coord", F.bround("coord", 6))


COLLINEAR_SQL = with_views("seg", _COLL + " SELECT page_id, orient, bin, lo, hi, round_even(coord, 6) AS coord, covered FROM rules WHERE covered >= 400")


def coverage_window(spark, d):
    return intervals.coverage(V.page_segments(spark, d), ORIENT, F.lit(100.0), F.lit(600.0))


COVERAGE_SQL = with_views(
    "seg",
    """, c AS (SELECT page_id, orient, greatest(lo, 100.0) AS a, greatest(greatest(lo, 100.0), least(hi, 600.0)) AS b FROM seg),
w AS (SELECT *, max(b) OVER (PARTITION BY page_id, orient ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM c)
SELECT page_id, orient, sum(greatest(0, b - greatest(a, coalesce(reach, a))))::DOUBLE AS covered FROM w GROUP BY ALL""",
)


def rule_runs(spark, d):
    s = V.page_segments(spark, d).withColumn("line", F.floor("coord"))
    return intervals.runs(s, ["page_id", "orient", "line"], 1.5)


RUNS_SQL = with_views(
    "seg",
    """, s AS (SELECT *, CAST(floor(coord) AS BIGINT) AS line FROM seg),
w AS (SELECT *, max(hi) OVER (PARTITION BY page_id, orient, line ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
n AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach + 1.5 THEN 1 ELSE 0 END) OVER (PARTITION BY page_id, orient, line ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM w)
SELECT page_id, orient, line, run::BIGINT AS run, min(lo) AS lo, max(hi) AS hi, count(*) AS n FROM n GROUP BY page_id, orient, line, run""",
)


def sheet_bands(spark, d):
    cells = V.segments(spark, d, 8).filter("orient = 'H'").selectExpr("page_id", "CAST(floor(coord) AS BIGINT) AS cell")
    return intervals.bands(cells, PAGE, 12, 20)


BANDS_SQL = with_views(
    "sheet",
    """, c AS (SELECT DISTINCT page_id, CAST(floor(coord) AS BIGINT) AS cell FROM sheet WHERE orient = 'H'),
g AS (SELECT *, cell - lag(cell) OVER (PARTITION BY page_id ORDER BY cell) - 1 AS gap FROM c),
b AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap >= 12 THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY cell) AS band FROM g),
r AS (SELECT page_id, band::BIGINT AS band, min(cell) AS first, max(cell) AS last FROM b GROUP BY ALL HAVING max(cell) - min(cell) + 1 > 20),
k AS (SELECT *, last - first + 1 AS len, count(*) OVER (PARTITION BY page_id) AS n, row_number() OVER (PARTITION BY page_id ORDER BY last - first, first) AS rn FROM r)
SELECT page_id, band, first, last, n > 1 AND len > 1.5 * max(CASE WHEN rn = n // 2 + 1 THEN len END) OVER (PARTITION BY page_id) AS wide FROM k""",
)


def interval_meet(spark, d):
    r = intervals.runs(V.segments(spark, d, 8), ORIENT, 0.0)
    h, v = (r.filter(F.col("orient") == o).select("page_id", "lo", "hi") for o in "HV")
    return intervals.meet(h, v, PAGE)


MEET_SQL = with_views(
    "sheet",
    """, w AS (SELECT *, max(hi) OVER (PARTITION BY page_id, orient ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM sheet),
n AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach THEN 1 ELSE 0 END) OVER (PARTITION BY page_id, orient ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM w),
r AS (SELECT page_id, orient, run, min(lo) AS lo, max(hi) AS hi FROM n GROUP BY ALL)
SELECT a.page_id, greatest(a.lo, b.lo) AS lo, least(a.hi, b.hi) AS hi FROM r a JOIN r b ON a.page_id = b.page_id AND a.orient = 'H' AND b.orient = 'V' WHERE least(a.hi, b.hi) > greatest(a.lo, b.lo)""",
)


def double_rule_collapse(spark, d):
    return intervals.collapse_close(V.segments(spark, d), ORIENT, "coord", 1.5)


COLLAPSE_SQL = with_views(
    "seg",
    """, v AS (SELECT page_id, orient, list_sort(list_distinct(list(coord))) AS vs FROM seg GROUP BY ALL),
k(page_id, orient, vs, c) AS (SELECT page_id, orient, vs, vs[1] FROM v UNION ALL
  SELECT page_id, orient, vs, list_filter(vs, lambda x: x - c > 1.5)[1] FROM k WHERE len(list_filter(vs, lambda x: x - c > 1.5)) > 0)
SELECT page_id, orient, c AS coord FROM k""",
)


def second_line(spark, d):
    return intervals.nth_from_edge(V.segments(spark, d), ORIENT, "coord", 2, 1.5)


SECOND_SQL = with_views(
    "seg",
    """, f AS (SELECT page_id, orient, min(coord) AS c1 FROM seg GROUP BY ALL)
SELECT s.page_id, s.orient, min(s.coord) AS coord FROM seg s JOIN f USING (page_id, orient) WHERE s.coord - c1 > 1.5 GROUP BY ALL""",
)


def row_chains(spark, d):
    s = V.segments(spark, d, 8).select("page_id", "orient", "coord").distinct()
    return intervals.gap_chains(s, ORIENT, "coord", 24.0, 3)


CHAINS_SQL = with_views(
    "sheet",
    """, s AS (SELECT DISTINCT page_id, orient, coord FROM sheet),
g AS (SELECT *, lag(coord) OVER (PARTITION BY page_id, orient ORDER BY coord) AS p FROM s),
c AS (SELECT *, sum(CASE WHEN p IS NULL OR coord - p >= 24.0 THEN 1 ELSE 0 END) OVER (PARTITION BY page_id, orient ORDER BY coord) AS ch FROM g)
SELECT page_id, orient, min(coord) AS first, max(coord) AS last, count(*) AS n FROM c GROUP BY page_id, orient, ch HAVING count(*) >= 3""",
)


def equal_pitch_runs(spark, d):
    return intervals.equal_pitch_runs(V.segments(spark, d), ORIENT, "coord")


def frame_detect(spark, d):
    return frames.detect(V.page_segments(spark, d), PAGE, 0.6, 0.3)


_FRAME = (
    _COLL
    + """, ext AS (SELECT page_id, min(CASE WHEN orient = 'H' THEN lo ELSE coord END) AS ex0, max(CASE WHEN orient = 'H' THEN hi ELSE coord END) AS ex1,
  min(CASE WHEN orient = 'H' THEN coord ELSE lo END) AS ey0, max(CASE WHEN orient = 'H' THEN coord ELSE hi END) AS ey1 FROM seg GROUP BY page_id),
lr AS (SELECT r.*, ext.* EXCLUDE (page_id) FROM rules r JOIN ext USING (page_id) WHERE covered >= 0.6 * CASE WHEN orient = 'H' THEN ex1 - ex0 ELSE ey1 - ey0 END),
fo AS (SELECT page_id, max(coord) FILTER (orient = 'V' AND coord <= ex0 + 0.3 * (ex1 - ex0)) AS l, min(coord) FILTER (orient = 'V' AND coord >= ex1 - 0.3 * (ex1 - ex0)) AS r,
  max(coord) FILTER (orient = 'H' AND coord <= ey0 + 0.3 * (ey1 - ey0)) AS t, min(coord) FILTER (orient = 'H' AND coord >= ey1 - 0.3 * (ey1 - ey0)) AS b FROM lr GROUP BY page_id),
fr AS (SELECT page_id, coalesce(l, ex0) AS x0, coalesce(t, ey0) AS y0, coalesce(r, ex1) AS x1, coalesce(b, ey1) AS y1,
  (l IS NOT NULL)::INTEGER + (r IS NOT NULL)::INTEGER + (t IS NOT NULL)::INTEGER + (b IS NOT NULL)::INTEGER AS found FROM ext LEFT JOIN fo USING (page_id))"""
)


def _rounded(df, cols):
    return df.withColumns({c: F.bround(c, 6) for c in cols})


def frame_detect_q(spark, d):
    return _rounded(frame_detect(spark, d), G.SIDES)


FRAME_SQL = with_views("seg", _FRAME + " SELECT page_id, round_even(x0, 6) AS x0, round_even(y0, 6) AS y0, round_even(x1, 6) AS x1, round_even(y1, 6) AS y1, found FROM fr")


def fingerprint_cells(spark, d):
    s = V.page_segments(spark, d)
    cells = frames.grid_cells(s, frames.detect(s, PAGE, 0.6, 0.3), PAGE)
    return cells.groupBy("page_id", "plane").agg(F.count(F.lit(1)).alias("cells"), F.sum(F.col("ix") * 40 + F.col("iy")).alias("place"))


CELLS_SQL = with_views(
    "seg",
    _FRAME
    + """, z AS (SELECT r.page_id, r.orient, r.lo, r.hi, r.coord, r.covered, CASE WHEN orient = 'H' THEN x0 ELSE y0 END AS a0, CASE WHEN orient = 'H' THEN x1 ELSE y1 END AS a1,
  CASE WHEN orient = 'H' THEN y0 ELSE x0 END AS c0, CASE WHEN orient = 'H' THEN y1 ELSE x1 END AS c1 FROM rules r JOIN fr USING (page_id)),
k AS (SELECT *, least(39, greatest(0, CAST(trunc((coord - c0) / (c1 - c0) * 40) AS INTEGER))) AS pos, greatest(0, CAST(trunc((greatest(lo, a0) - a0) / (a1 - a0) * 40) AS INTEGER)) AS f,
  least(39, CAST(trunc((least(hi, a1) - a0) / (a1 - a0) * 40) AS INTEGER)) AS l FROM z
  WHERE a1 > a0 AND c1 > c0 AND covered >= 0.1 * (a1 - a0) AND coord BETWEEN c0 - 0.02 * (c1 - c0) AND c1 + 0.02 * (c1 - c0)),
e AS (SELECT page_id, orient, pos, unnest(range(f, l + 1)) AS i FROM k WHERE f <= l),
cells AS (SELECT DISTINCT page_id, CASE WHEN orient = 'H' THEN 0 ELSE 1 END AS plane, CASE WHEN orient = 'H' THEN i ELSE pos END AS ix, CASE WHEN orient = 'H' THEN pos ELSE i END AS iy FROM e)
SELECT page_id, plane, count(*) AS cells, sum(ix * 40 + iy)::BIGINT AS place FROM cells GROUP BY ALL""",
)


# -- range joins ----------------------------------------------------------------------------------------------------
_NEAR = "a.x1 + {g} >= b.x0 AND b.x1 + {g} >= a.x0 AND a.y1 + {g} >= b.y0 AND b.y1 + {g} >= a.y0"
_DIST = "sqrt(pow(greatest(0, greatest(a.x0, b.x0) - least(a.x1, b.x1)), 2) + pow(greatest(0, greatest(a.y0, b.y0) - least(a.y1, b.y1)), 2))"


def close_pairs(spark, d):
    b = V.boxes(spark, d)
    p = joins.box_join(b, b, PAGE, 10.0, self_id="box_id")
    return p.select("page_id", F.col("a_box_id").alias("a"), F.col("b_box_id").alias("b"), F.bround(G.distance(G.of("a_"), G.of("b_")), 6).alias("distance"), F.bround(G.manhattan(G.of("a_"), G.of("b_")), 6).alias("manhattan"))


CLOSE_SQL = with_views("box", f" SELECT a.page_id, a.box_id AS a, b.box_id AS b, round_even({_DIST}, 6) AS distance, round_even(greatest(0, greatest(a.x0, b.x0) - least(a.x1, b.x1)) + greatest(0, greatest(a.y0, b.y0) - least(a.y1, b.y1)), 6) AS manhattan FROM box a JOIN box b ON a.page_id = b.page_id AND a.box_id < b.box_id AND {_NEAR.format(g=10)}")


def furniture_drop(spark, d):
    return joins.outside(V.boxes(spark, d), V.furniture(spark, d), PAGE, "box_id", slack=0.6, centre=True)


FURN_SQL = with_views("box furn", " SELECT * FROM box b WHERE NOT EXISTS (SELECT 1 FROM furn f WHERE f.page_id = b.page_id AND (b.x0 + b.x1) / 2 BETWEEN f.x0 - 0.6 AND f.x1 + 0.6 AND (b.y0 + b.y1) / 2 BETWEEN f.y0 - 0.6 AND f.y1 + 0.6)")


def first_group(spark, d):
    out = joins.first_inside(V.boxes(spark, d), V.furniture(spark, d), PAGE, "box_id", "furn_id", slack=0.6)
    return out.select("page_id", F.col("a_box_id").alias("box_id"), F.col("b_furn_id").alias("furn_id"))


FIRST_SQL = with_views("box furn", " SELECT b.page_id, b.box_id, min(f.furn_id) AS furn_id FROM box b JOIN furn f ON f.page_id = b.page_id AND b.x0 >= f.x0 - 0.6 AND b.x1 <= f.x1 + 0.6 AND b.y0 >= f.y0 - 0.6 AND b.y1 <= f.y1 + 0.6 GROUP BY ALL")


def nearest_block(spark, d):
    b = V.boxes(spark, d)
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    out = joins.nearest(b.filter(area < 30), b.filter(area >= 30), PAGE, "box_id", 30.0, [F.col("b_box_id")])
    return out.select("page_id", F.col("a_box_id").alias("box_id"), F.col("b_box_id").alias("block_id"), F.bround("distance", 6).alias("distance"))


NEAREST_SQL = with_views("box", f", p AS (SELECT a.page_id, a.box_id, b.box_id AS block_id, {_DIST} AS dist FROM box a JOIN box b ON a.page_id = b.page_id AND (a.x1 - a.x0) * (a.y1 - a.y0) < 30 AND (b.x1 - b.x0) * (b.y1 - b.y0) >= 30) SELECT page_id, box_id, block_id, round_even(dist, 6) AS distance FROM p WHERE dist <= 30 QUALIFY row_number() OVER (PARTITION BY page_id, box_id ORDER BY dist, block_id) = 1")


def image_assign(spark, d):
    return joins.best_overlap(V.boxes(spark, d), V.furniture(spark, d), PAGE, "box_id", "furn_id", 64.0).withColumn("distance", F.bround("distance", 6))


_OVER = "greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0))"
IMAGE_SQL = with_views("box furn", f", p AS (SELECT a.page_id, a.box_id, b.furn_id, {_OVER} AS overlap, {_DIST} AS dist FROM box a JOIN furn b ON a.page_id = b.page_id AND {_NEAR.format(g=64)}) SELECT page_id, box_id, furn_id, overlap, round_even(dist, 6) AS distance FROM p QUALIFY row_number() OVER (PARTITION BY page_id, box_id ORDER BY overlap DESC, dist, furn_id) = 1")


def caption_attach(spark, d):
    b = V.boxes(spark, d)
    h, w = F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")
    cap, main = b.filter((h < 4) & (w > 4)), b.filter((h >= 4) & (w > 0))
    p = joins.box_join(cap, main, PAGE, 42.0)
    over = F.least("a_x1", "b_x1") - F.greatest("a_x0", "b_x0")
    above = (F.col("b_y1") <= F.col("a_y0") + 2) & (F.col("a_y0") - F.col("b_y1") <= 40) & (over >= 0.5 * F.least(F.col("a_x1") - F.col("a_x0"), F.col("b_x1") - F.col("b_x0")))
    dist = G.distance(G.of("a_"), G.of("b_"))
    p = p.withColumns({"up": above, "dist": dist, "rise": F.col("a_y0") - F.col("b_y1")}).filter(above | (dist <= 25))
    by = F.struct((~F.col("up")).cast("int").alias("u"), F.when(F.col("up"), F.col("rise")).otherwise(F.col("dist")).alias("d"), F.col("b_box_id").alias("b"))
    return p.groupBy("page_id", F.col("a_box_id").alias("box_id")).agg(F.min(by).alias("m")).select("page_id", "box_id", F.col("m.b").alias("drawing_id"), (F.col("m.u") == 0).alias("above"))


CAPTION_SQL = with_views(
    "box",
    f""", p AS (SELECT a.page_id, a.box_id, b.box_id AS bid, {_DIST} AS dist, a.y0 - b.y1 AS rise,
  b.y1 <= a.y0 + 2 AND a.y0 - b.y1 <= 40 AND least(a.x1, b.x1) - greatest(a.x0, b.x0) >= 0.5 * least(a.x1 - a.x0, b.x1 - b.x0) AS up
  FROM box a JOIN box b ON a.page_id = b.page_id AND a.y1 - a.y0 < 4 AND a.x1 - a.x0 > 4 AND b.y1 - b.y0 >= 4 AND b.x1 > b.x0)
SELECT page_id, box_id, bid AS drawing_id, up AS above FROM p WHERE up OR dist <= 25
QUALIFY row_number() OVER (PARTITION BY page_id, box_id ORDER BY up DESC, CASE WHEN up THEN rise ELSE dist END, bid) = 1""",
)


def cell_of_label(spark, d):
    pts = V.boxes(spark, d).selectExpr("box_id AS page_id", "box_id", "x0 AS x", "y0 AS y")
    lines = V.segments(spark, d, 8)
    return joins.span_lines(pts, lines, PAGE, "box_id")


CELL_SQL = with_views(
    "box sheet",
    """, p AS (SELECT box_id AS page_id, box_id, x0 AS x, y0 AS y FROM box), l AS (SELECT page_id, orient, coord AS c, lo, hi FROM sheet)
SELECT p.page_id, p.box_id, max(c) FILTER (orient = 'V' AND c <= x) AS "left", min(c) FILTER (orient = 'V' AND c > x) AS "right", max(c) FILTER (orient = 'H' AND c <= y) AS top, min(c) FILTER (orient = 'H' AND c > y) AS bottom
FROM p LEFT JOIN l ON p.page_id = l.page_id AND CASE WHEN orient = 'V' THEN y ELSE x END BETWEEN lo - 0.8 AND hi + 0.8 GROUP BY ALL""",
)


def _moved(spark, d):
    return V.boxes(spark, d).withColumns({"dst_x": F.col("x0") + F.col("box_id") % 3, "dst_y": F.col("y0") + (F.col("box_id") % 4) * 1.5})


def neighbor_displaced(spark, d):
    b = _moved(spark, d)
    p = joins.box_join(b, b, PAGE, 15.0, self_id="box_id").filter(G.distance(G.of("a_"), G.of("b_")) <= 15)
    return layout.displaced(p).select("page_id", F.col("a_box_id").alias("a"), F.col("b_box_id").alias("b"), F.bround("shift", 6).alias("shift"))


DISPLACED_SQL = with_views(
    "box",
    f""", m AS (SELECT *, box_id % 3 AS dx, (box_id % 4) * 1.5 AS dy FROM box),
p AS (SELECT a.page_id, a.box_id AS a, b.box_id AS b, sqrt(pow(a.dx - b.dx, 2) + pow((a.dy - b.dy)::DOUBLE, 2)) AS s FROM m a JOIN m b ON a.page_id = b.page_id AND a.box_id < b.box_id AND {_DIST} <= 15)
SELECT page_id, a, b, round_even(s, 6) AS shift FROM p WHERE s > 2""",
)


def narrow_displaced(spark, d):
    b = _moved(spark, d)
    small = F.least(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    p = joins.nearest(b.filter(small < 4), b.filter(small >= 4), PAGE, "box_id", 10.0, [F.col("b_box_id")])
    return layout.displaced(p).select("page_id", F.col("a_box_id").alias("narrow"), F.col("b_box_id").alias("neighbor"), F.bround("shift", 6).alias("shift"))


NARROW_SQL = with_views(
    "box",
    f""", m AS (SELECT *, box_id % 3 AS dx, (box_id % 4) * 1.5 AS dy, least(x1 - x0, y1 - y0) AS sm FROM box),
p AS (SELECT a.page_id, a.box_id AS narrow, b.box_id AS neighbor, sqrt(pow(a.dx - b.dx, 2) + pow((a.dy - b.dy)::DOUBLE, 2)) AS s, {_DIST} AS dist FROM m a JOIN m b ON a.page_id = b.page_id AND a.sm < 4 AND b.sm >= 4),
n AS (SELECT * FROM p WHERE dist <= 10 QUALIFY row_number() OVER (PARTITION BY page_id, narrow ORDER BY dist, neighbor) = 1)
SELECT page_id, narrow, neighbor, round_even(s, 6) AS shift FROM n WHERE s > 2""",
)


# -- graphs ---------------------------------------------------------------------------------------------------------
def components(spark, d):
    c = graph.box_components(V.boxes(spark, d), PAGE, "box_id", 10.0)
    return c.select(F.col("v").alias("box_id"), "comp")


_REACH = "r(v, u) AS (SELECT a, b FROM e UNION SELECT r.v, e.b FROM r JOIN e ON r.u = e.a)"


def _edges(g):
    return f", e AS (SELECT a.box_id AS a, b.box_id AS b FROM box a JOIN box b ON a.page_id = b.page_id AND {_NEAR.format(g=g)})"


COMPONENTS_SQL = with_views("box", _edges(10) + f", {_REACH} SELECT v AS box_id, min(u) AS comp FROM r GROUP BY v")


def must_link(spark, d):
    b = V.boxes(spark, d)
    tie = graph.must_link(b.withColumn("grp", F.col("box_id") % 400).filter("grp < 40"), "grp", "box_id")
    c = graph.box_components(b, PAGE, "box_id", 2.0, tie)
    return c.select(F.col("v").alias("box_id"), "comp")


MUST_SQL = with_views("box", f", e AS (SELECT a.box_id AS a, b.box_id AS b FROM box a JOIN box b ON (a.page_id = b.page_id AND {_NEAR.format(g=2)}) OR (a.box_id % 400 = b.box_id % 400 AND a.box_id % 400 < 40)), {_REACH} SELECT v AS box_id, min(u) AS comp FROM r GROUP BY v")


def margin_attach(spark, d):
    b = V.boxes(spark, d)
    e = joins.box_join(b, b, PAGE, 12.0, self_id="box_id").select(F.col("a_box_id").alias("a"), F.col("b_box_id").alias("b"))
    seeds = b.filter("x0 BETWEEN 200 AND 300 AND y0 BETWEEN 150 AND 250").select(F.col("box_id").alias("v"))
    return graph.reachable(seeds, e).withColumnRenamed("v", "box_id")


MARGIN_SQL = with_views("box", _edges(12) + ", r(v) AS (SELECT box_id FROM box WHERE x0 BETWEEN 200 AND 300 AND y0 BETWEEN 150 AND 250 UNION SELECT e.b FROM r JOIN e ON r.v = e.a) SELECT v AS box_id FROM r")


def overlap_merge(spark, d):
    return graph.merge_overlapping(V.boxes(spark, d).filter("x1 > x0 AND y1 > y0"), PAGE, "box_id", 0.2)


# -- block rules ----------------------------------------------------------------------------------------------------
def _members(spark, d):
    return V.boxes(spark, d).withColumn("block", F.floor(F.col("x0") / 160) * 10 + F.floor(F.col("y0") / 140))


_MEM = ", m AS (SELECT *, CAST(floor(x0 / 160) * 10 + floor(y0 / 140) AS BIGINT) AS block, greatest(x1 - x0, y1 - y0) AS sz FROM box)"
BLOCK = ["page_id", "block"]


def block_stats(spark, d):
    s = blocks.stats(_members(spark, d), BLOCK)
    return s.withColumns({"stray": blocks.stray(s), "outlined": blocks.outlined_text(s), "small": F.bround("small", 6)})


STATS_SQL = with_views(
    "box",
    _MEM
    + """, s AS (SELECT page_id, block, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS n, avg((sz < 9)::INTEGER) AS small, count(*) FILTER (sz >= 30) AS long, max(sz) AS largest, count(*) FILTER (y1 - y0 < 2) AS flat FROM m GROUP BY ALL)
SELECT page_id, block, x0, y0, x1, y1, n, round_even(small, 6) AS small, "long", largest, flat, n <= 2 OR (n <= 6 AND least(x1 - x0, y1 - y0) < 2) AS stray, n > 40 AND small >= 0.98 AND "long" = 0 AS outlined FROM s""",
)


def table_detect(spark, d):
    return blocks.table_like(_members(spark, d), BLOCK, 0.06, 3)


TABLE_SQL = with_views("box", _MEM + ", w AS (SELECT *, max(x1) OVER (PARTITION BY page_id, block) - min(x0) OVER (PARTITION BY page_id, block) AS bw FROM m) SELECT page_id, block, count(*) FILTER (y1 - y0 < 2 AND x1 - x0 > 0.06 * bw) AS rules, count(*) FILTER (y1 - y0 < 2 AND x1 - x0 > 0.06 * bw) >= 3 AS is_table FROM w GROUP BY ALL")


def text_detect(spark, d):
    return blocks.text_like(_members(spark, d), BLOCK, 400.0, 0.5).withColumn("tiny", F.bround("tiny", 6))


TEXT_SQL = with_views("box", _MEM + " SELECT page_id, block, round_even(avg((sz < 8)::INTEGER), 6) AS tiny, avg((sz < 8)::INTEGER) >= 0.5 AS is_text FROM m GROUP BY ALL")


def iso_detect(spark, d):
    s = V.table(spark, d, "lineitem").selectExpr("l_orderkey % 997 AS page_id", "CAST(l_partkey % 41 - 20 AS DOUBLE) AS dx", "CAST(l_suppkey % 37 - 18 AS DOUBLE) AS dy")
    return blocks.slanted(s, PAGE)


ISO_SQL = """WITH s AS (SELECT l_orderkey % 997 AS page_id, CAST(l_partkey % 41 - 20 AS DOUBLE) AS dx, CAST(l_suppkey % 37 - 18 AS DOUBLE) AS dy FROM lineitem),
a AS (SELECT *, degrees(atan2(dy, dx)) AS g FROM s),
b AS (SELECT page_id, CAST(floor((CASE WHEN g < 0 THEN (g + 180) % 180 ELSE g % 180 END) / 10) AS INTEGER) AS bucket, abs(dx) > 0.15 * abs(dy) AND abs(dy) > 0.15 * abs(dx) AS tilt FROM a),
p AS (SELECT page_id, bucket, count(*) AS n, count(*) FILTER (tilt) AS t FROM b GROUP BY ALL),
q AS (SELECT *, (n >= 0.08 * sum(n) OVER (PARTITION BY page_id))::INTEGER AS big FROM p),
r AS (SELECT page_id, sum(n)::BIGINT AS lines, sum(t)::BIGINT AS slanted, sum(big)::BIGINT AS directions FROM q GROUP BY page_id)
SELECT *, lines > 12 AND slanted >= 0.3 * lines AND directions >= 3 AS is_3d FROM r"""


def mask_drop(spark, d):
    p = V.boxes(spark, d).selectExpr("page_id", "box_id AS seq", "box_id % 6 = 0 AS is_white", "floor(x0 / 400) * 400 AS x0", "floor(y0 / 280) * 280 AS y0", "floor(x0 / 400) * 400 + CASE WHEN box_id % 6 = 0 THEN 400 ELSE 50 END AS x1", "floor(y0 / 280) * 280 + CASE WHEN box_id % 6 = 0 THEN 280 ELSE 60 END AS y1")
    return blocks.masks(p.selectExpr("page_id", "seq", "is_white", *[f"CAST({c} AS DOUBLE) AS {c}" for c in G.SIDES]), PAGE)


MASK_SQL = with_views(
    "box",
    """, p AS (SELECT page_id, box_id AS seq, box_id % 6 = 0 AS wh, floor(x0 / 400) * 400 AS x0, floor(y0 / 280) * 280 AS y0, floor(x0 / 400) * 400 + CASE WHEN box_id % 6 = 0 THEN 400 ELSE 50 END AS x1, floor(y0 / 280) * 280 + CASE WHEN box_id % 6 = 0 THEN 280 ELSE 60 END AS y1 FROM box)
SELECT a.page_id, a.seq, count(*) AS later FROM p a JOIN p b ON a.page_id = b.page_id AND a.wh AND NOT b.wh AND b.seq BETWEEN a.seq + 1 AND a.seq + 79 AND b.x0 >= a.x0 - 0.5 AND b.y0 >= a.y0 - 0.5 AND b.x1 <= a.x1 + 0.5 AND b.y1 <= a.y1 + 0.5 GROUP BY ALL HAVING count(*) >= 2""",
)


def table_border_restore(spark, d):
    s = V.segments(spark, d)
    h = s.filter("orient = 'H'").select("page_id", "coord", "lo", "hi")
    v = s.filter("orient = 'V'").select("page_id", "coord", "lo", "hi")
    return blocks.border_gaps(h, v, PAGE).withColumn("share", F.bround("share", 6))


BORDER_SQL = with_views(
    "seg",
    """, e AS (SELECT page_id, round_even(unnest([lo, hi]), 0) AS x, coord FROM seg WHERE orient = 'H'),
s AS (SELECT page_id, x, min(coord) AS lo, max(coord) AS hi FROM e GROUP BY ALL HAVING count(DISTINCT coord) >= 3),
c AS (SELECT s.*, greatest(v.lo, s.lo) AS a, least(v.hi, s.hi) AS b FROM s LEFT JOIN seg v ON v.orient = 'V' AND v.page_id = s.page_id AND round_even(v.coord, 0) = s.x),
w AS (SELECT *, max(b) OVER (PARTITION BY page_id, x ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM c),
k AS (SELECT page_id, x, lo, hi, sum(coalesce(greatest(0, b - greatest(a, coalesce(reach, a))), 0)) AS cov FROM w GROUP BY ALL)
SELECT page_id, x, lo, hi, round_even(cov / (hi - lo), 6) AS share FROM k WHERE hi > lo AND cov / (hi - lo) < 0.95""",
)


# -- rectangles -----------------------------------------------------------------------------------------------------
def rect_subtract(spark, d):
    p = joins.box_join(V.furniture(spark, d), V.furniture(spark, d), PAGE, self_id="furn_id")
    out = p.select("page_id", "a_furn_id", "b_furn_id", F.inline(G.subtract(G.of("a_"), G.of("b_"))))
    return out


SUBTRACT_SQL = with_views(
    "furn",
    """, p AS (SELECT a.page_id, a.furn_id AS a_furn_id, b.furn_id AS b_furn_id, a.x0, a.y0, a.x1, a.y1, greatest(a.x0, b.x0) AS i0, greatest(a.y0, b.y0) AS j0, least(a.x1, b.x1) AS i1, least(a.y1, b.y1) AS j1
  FROM furn a JOIN furn b ON a.page_id = b.page_id AND a.furn_id < b.furn_id AND a.x1 >= b.x0 AND b.x1 >= a.x0 AND a.y1 >= b.y0 AND b.y1 >= a.y0),
s AS (SELECT page_id, a_furn_id, b_furn_id, x0, y0, x1, j0 AS y1 FROM p WHERE i1 > i0 AND j1 > j0 AND j0 > y0 UNION ALL
  SELECT page_id, a_furn_id, b_furn_id, x0, j1, x1, y1 FROM p WHERE i1 > i0 AND j1 > j0 AND j1 < y1 UNION ALL
  SELECT page_id, a_furn_id, b_furn_id, x0, j0, i0, j1 FROM p WHERE i1 > i0 AND j1 > j0 AND i0 > x0 UNION ALL
  SELECT page_id, a_furn_id, b_furn_id, i1, j0, x1, j1 FROM p WHERE i1 > i0 AND j1 > j0 AND i1 < x1 UNION ALL
  SELECT page_id, a_furn_id, b_furn_id, x0, y0, x1, y1 FROM p WHERE NOT (i1 > i0 AND j1 > j0))
SELECT * FROM s WHERE x1 - x0 > 0.01 AND y1 - y0 > 0.01""",
)


def region_difference(spark, d):
    f = V.furniture(spark, d).groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("furn_id", G.of().alias("r")))).alias("c"))
    page = G.rect(F.lit(0), F.lit(0), F.lit(820), F.lit(580))
    out = f.select("page_id", F.inline(G.subtract_all(F.array(page), F.transform("c", lambda x: x["r"]))))
    return out.groupBy("page_id").agg(F.sum(G.area(G.of())).alias("area"))


REGION_SQL = with_views(
    "furn",
    """, g AS (SELECT unnest(range(820)) AS x), h AS (SELECT unnest(range(580)) AS y), pages AS (SELECT DISTINCT page_id FROM furn),
c AS (SELECT p.page_id, g.x, h.y FROM pages p, g, h WHERE NOT EXISTS (SELECT 1 FROM furn f WHERE f.page_id = p.page_id AND g.x >= f.x0 AND g.x < f.x1 AND h.y >= f.y0 AND h.y < f.y1))
SELECT page_id, count(*)::DOUBLE AS area FROM c GROUP BY page_id""",
)


def dominated_drop(spark, d):
    b = V.boxes(spark, d).withColumns({"x1": F.col("x1") + (F.col("box_id") % 7) * 20, "y1": F.col("y1") + (F.col("box_id") % 5) * 20})
    return layout.dominated(b, PAGE, "box_id")


DOMINATED_SQL = with_views("box", ", big AS (SELECT page_id, box_id, x0, y0, x1 + (box_id % 7) * 20 AS x1, y1 + (box_id % 5) * 20 AS y1 FROM box) SELECT * FROM big a WHERE NOT EXISTS (SELECT 1 FROM big b WHERE b.page_id = a.page_id AND b.box_id <> a.box_id AND b.x0 <= a.x0 AND b.y0 <= a.y0 AND b.x1 >= a.x1 AND b.y1 >= a.y1 AND (NOT (b.x0 = a.x0 AND b.y0 = a.y0 AND b.x1 = a.x1 AND b.y1 = a.y1 OR (b.x1 - b.x0) * (b.y1 - b.y0) = (a.x1 - a.x0) * (a.y1 - a.y0) AND a.x0 <= b.x0 AND a.y0 <= b.y0 AND a.x1 >= b.x1 AND a.y1 >= b.y1) OR b.box_id < a.box_id))")


def box_measures(spark, d):
    b = V.boxes(spark, d)
    r = G.of()
    return b.select(
        "box_id", G.snap(F.col("x0") / 7).alias("snapped"), G.fraction(F.col("x0"), F.lit(0.0), F.lit(797.0)).alias("fx"), G.area(G.pad(r, 2.0)).alias("padded"),
        G.slant_bucket(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")).alias("slant"), G.valid_rect(r).alias("valid"), G.area(G.hull(r, G.pad(r, 1.0))).alias("hull"),
    )


MEASURE_SQL = with_views("box", " SELECT box_id, round_even(x0 / 7 * 64, 0) / 64 AS snapped, least(1.0, greatest(0.0, round_even(x0 / 797, 3)))::DOUBLE AS fx, (x1 - x0 + 4) * (y1 - y0 + 4) AS padded, CAST(floor(degrees(atan2(y1 - y0, x1 - x0)) / 10) AS INTEGER) AS slant, x1 > x0 AND y1 > y0 AS valid, (x1 - x0 + 2) * (y1 - y0 + 2) AS hull FROM box")


# -- placement ------------------------------------------------------------------------------------------------------
def _clips(spark, d):
    return V.boxes(spark, d).withColumns({"grp": F.col("box_id") % 50, "dst_x": ((F.col("box_id") % 50) * 16).cast("double"), "dst_y": ((F.col("box_id") % 7) * 0 + 30).cast("double"), "scale": F.lit(0.5)})


def placements(spark, d):
    return layout.placements(_clips(spark, d), ["page_id", "grp"]).select("page_id", "grp", "box_id", "t_x0", "t_y0", "t_x1", "t_y1")


PLACE_SQL = with_views("box", ", o AS (SELECT *, box_id % 50 AS grp, min(x0) OVER (PARTITION BY page_id, box_id % 50) AS ox, min(y0) OVER (PARTITION BY page_id, box_id % 50) AS oy FROM box) SELECT page_id, grp, box_id, grp * 16 + (x0 - ox) * 0.5 AS t_x0, 30 + (y0 - oy) * 0.5 AS t_y0, grp * 16 + (x1 - ox) * 0.5 AS t_x1, 30 + (y1 - oy) * 0.5 AS t_y1 FROM o")


def coverage_account(spark, d):
    b, f = layout.cells(V.boxes(spark, d), PAGE, 16.0), layout.cells(V.furniture(spark, d), PAGE, 16.0)
    return layout.uncovered(b, [f], PAGE).groupBy("page_id").agg(F.count(F.lit(1)).alias("left"))


_CELLS = "SELECT DISTINCT page_id, unnest(range(CAST(floor(x0 / 16) AS BIGINT), CAST(floor(x1 / 16) AS BIGINT) + 1)) AS ix, y0, y1 FROM {t}"
ACCOUNT_SQL = with_views(
    "box furn",
    f""", b0 AS ({_CELLS.format(t='box')}), f0 AS ({_CELLS.format(t='furn')}),
b AS (SELECT DISTINCT page_id, ix, unnest(range(CAST(floor(y0 / 16) AS BIGINT), CAST(floor(y1 / 16) AS BIGINT) + 1)) AS iy FROM b0), f AS (SELECT DISTINCT page_id, ix, unnest(range(CAST(floor(y0 / 16) AS BIGINT), CAST(floor(y1 / 16) AS BIGINT) + 1)) AS iy FROM f0)
SELECT page_id, count(*) AS "left" FROM b ANTI JOIN f USING (page_id, ix, iy) GROUP BY page_id""",
)


def preservation_ratio(spark, d):
    src = layout.cells(V.boxes(spark, d), PAGE, 16.0).withColumn("s", F.lit(1))
    out = layout.cells(V.boxes(spark, d).filter("box_id % 9 <> 0"), PAGE, 16.0).withColumn("o", F.lit(1))
    j = src.join(out, ["page_id", "ix", "iy"], "full_outer").groupBy("page_id").agg(F.count("s").alias("expected"), F.count_if(F.col("o").isNull()).alias("missing"), F.count_if(F.col("s").isNull()).alias("unexpected"))
    return j.withColumn("missing_ratio", F.bround(F.col("missing") / F.greatest(F.lit(1), "expected"), 6))


RATIO_SQL = with_views(
    "box",
    f""", b0 AS ({_CELLS.format(t='box')}), o0 AS ({_CELLS.format(t='(SELECT * FROM box WHERE box_id % 9 <> 0)')}),
b AS (SELECT DISTINCT page_id, ix, unnest(range(CAST(floor(y0 / 16) AS BIGINT), CAST(floor(y1 / 16) AS BIGINT) + 1)) AS iy FROM b0), o AS (SELECT DISTINCT page_id, ix, unnest(range(CAST(floor(y0 / 16) AS BIGINT), CAST(floor(y1 / 16) AS BIGINT) + 1)) AS iy FROM o0),
j AS (SELECT coalesce(b.page_id, o.page_id) AS page_id, b.ix AS s, o.ix AS o FROM b FULL JOIN o ON b.page_id = o.page_id AND b.ix = o.ix AND b.iy = o.iy)
SELECT page_id, count(s) AS expected, count(*) FILTER (o IS NULL) AS missing, count(*) FILTER (s IS NULL) AS unexpected, round_even(count(*) FILTER (o IS NULL) / greatest(1, count(s)), 6) AS missing_ratio FROM j GROUP BY page_id""",
)


def rail_split(spark, d):
    b = V.boxes(spark, d)
    return layout.side_or_main(b, F.lit(0.0), F.lit(800.0)).groupBy("page_id", "part").agg(F.count(F.lit(1)).alias("n"))


RAIL_SQL = with_views("box", " SELECT page_id, CASE WHEN (x0 + x1) / 2 > 0.58::DOUBLE * 800.0::DOUBLE THEN 'rail' ELSE 'view' END AS part, count(*) AS n FROM box GROUP BY ALL")

QUERIES = {
    "match_status": (match_status, MATCH_SQL), "match_top3_templates": (match_top3_templates, TOP3_SQL), "dilate": (dilate, DILATE_SQL), "pair_similarity": (pair_similarity, PAIR_SQL),
    "star_cluster": (star_cluster, None), "collinear_rules": (collinear_rules, COLLINEAR_SQL), "coverage_window": (coverage_window, COVERAGE_SQL), "rule_runs": (rule_runs, RUNS_SQL),
    "sheet_bands": (sheet_bands, BANDS_SQL), "interval_intersect": (interval_meet, MEET_SQL), "double_rule_collapse": (double_rule_collapse, COLLAPSE_SQL), "second_line": (second_line, SECOND_SQL),
    "row_chains": (row_chains, CHAINS_SQL), "equal_pitch_runs": (equal_pitch_runs, None), "frame_detect": (frame_detect_q, FRAME_SQL), "fingerprint_cells": (fingerprint_cells, CELLS_SQL),
    "close_pairs": (close_pairs, CLOSE_SQL), "furniture_drop": (furniture_drop, FURN_SQL), "first_group": (first_group, FIRST_SQL), "nearest_block": (nearest_block, NEAREST_SQL),
    "image_assign": (image_assign, IMAGE_SQL), "caption_attach": (caption_attach, CAPTION_SQL), "cell_of_label": (cell_of_label, CELL_SQL), "neighbor_displaced": (neighbor_displaced, DISPLACED_SQL),
    "narrow_displaced": (narrow_displaced, NARROW_SQL), "components": (components, COMPONENTS_SQL), "must_link": (must_link, MUST_SQL), "margin_attach": (margin_attach, MARGIN_SQL),
    "overlap_merge": (overlap_merge, None), "block_stats": (block_stats, STATS_SQL), "table_detect": (table_detect, TABLE_SQL), "text_detect": (text_detect, TEXT_SQL), "iso_detect": (iso_detect, ISO_SQL),
    "mask_drop": (mask_drop, MASK_SQL), "table_border_restore": (table_border_restore, BORDER_SQL), "rect_subtract": (rect_subtract, SUBTRACT_SQL), "region_difference": (region_difference, REGION_SQL),
    "dominated_drop": (dominated_drop, DOMINATED_SQL), "box_measures": (box_measures, MEASURE_SQL), "placements": (placements, PLACE_SQL), "coverage_account": (coverage_account, ACCOUNT_SQL),
    "preservation_ratio": (preservation_ratio, RATIO_SQL), "rail_split": (rail_split, RAIL_SQL),
}
