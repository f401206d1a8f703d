"""Queries on drawn paths: primitives, segments, strays, frames by policy, and what of the paths is drawing."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import paths
from rivulet.plans import proofs

#: 30 paths a page, of up to seven items; every third page has a frame of single lines, some with a ring or a title rule.
proofs.TABLES |= {
    "q_items": """SELECT page_id, path_id, item_id, op, p1x, p1y, p2x, p2y, p3x, p3y, p4x, p4y, stroked, width FROM (
  SELECT page_id, path_id, item_id, CASE WHEN u % 9 = 0 THEN 're' WHEN u % 9 = 1 THEN 'qu' WHEN u % 9 = 2 THEN 'c' ELSE 'l' END AS op, x AS p1x, y AS p1y,
    CASE WHEN u % 9 IN (0, 1, 2) OR u % 2 = 0 THEN x + w ELSE x + t END AS p2x, CASE WHEN u % 9 IN (0, 2) THEN y + h WHEN u % 9 = 1 THEN y + t WHEN u % 2 = 0 THEN y + t ELSE y + h END AS p2y,
    CASE WHEN u % 9 = 1 THEN x WHEN u % 9 = 2 THEN x + 3 END AS p3x, CASE WHEN u % 9 = 1 THEN y + h WHEN u % 9 = 2 THEN y + 9 END AS p3y,
    CASE WHEN u % 9 = 1 THEN x + w + CASE WHEN u % 4 = 0 THEN 2 ELSE 0 END WHEN u % 9 = 2 THEN x + w END AS p4x, CASE WHEN u % 9 IN (1, 2) THEN y + h END AS p4y, u % 3 > 0 AS stroked, CAST(0.25 * (u % 5) AS DOUBLE) AS width
  FROM (SELECT CAST(floor(k / 30) AS BIGINT) AS page_id, k AS path_id, k * 10 + n AS item_id, u, CAST((37 * k + 11 * n) % 700 + 30 + CASE WHEN u % 41 = 0 THEN 2000 ELSE 0 END AS DOUBLE) AS x, CAST((53 * k + 29 * n) % 500 + 20 AS DOUBLE) AS y,
      CAST(CASE WHEN u % 7 = 0 THEN 0 WHEN u % 23 = 0 THEN 690 ELSE u % 90 END AS DOUBLE) AS w, CAST(u % 70 AS DOUBLE) AS h, CAST(CASE WHEN u % 5 = 0 THEN 0.5 WHEN u % 5 = 1 THEN 0.2 ELSE 0 END AS DOUBLE) AS t
    FROM (SELECT l_orderkey AS k, l_linenumber AS n, max(CAST(l_partkey % 1009 + l_quantity AS BIGINT)) AS u FROM {lineitem} GROUP BY l_orderkey, l_linenumber) r) s) t
  UNION ALL SELECT page_id, 1000000000 + page_id * 100 + i, 1000000000 + page_id * 100 + i, 'l', x0, y0, x1, y1, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), true, CAST(0.5 AS DOUBLE) FROM (
    SELECT page_id, i, CAST(CASE i WHEN 0 THEN 12 WHEN 1 THEN 12 WHEN 2 THEN 12 WHEN 3 THEN 788 WHEN 4 THEN 20 ELSE 12 END AS DOUBLE) AS x0, CAST(CASE i WHEN 0 THEN 10 WHEN 1 THEN 590 WHEN 2 THEN 10 WHEN 3 THEN 10 WHEN 4 THEN 580 ELSE 500 END AS DOUBLE) AS y0,
      CAST(CASE i WHEN 2 THEN 12 WHEN 4 THEN 780 ELSE 788 END AS DOUBLE) AS x1, CAST(CASE i WHEN 0 THEN 10 WHEN 1 THEN 590 WHEN 4 THEN 580 WHEN 5 THEN 500 ELSE 590 END AS DOUBLE) AS y1
    FROM (SELECT DISTINCT CAST(floor(o_orderkey / 30) AS BIGINT) AS page_id FROM {orders}) p, (SELECT 0 AS i UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5) n
    WHERE page_id % 3 < 2 AND NOT (i = 4 AND page_id % 2 = 0) AND NOT (i = 5 AND page_id % 5 > 1)) f""",
    "q_pages": "SELECT DISTINCT CAST(floor(o_orderkey / 30) AS BIGINT) AS page_id, CAST(0 AS DOUBLE) AS x0, CAST(0 AS DOUBLE) AS y0, CAST(800 AS DOUBLE) AS x1, CAST(600 AS DOUBLE) AS y1 FROM {orders}",
    "q_areas": """SELECT page_id, CAST(500 AS DOUBLE) AS x0, CAST(430 AS DOUBLE) AS y0, CAST(788 AS DOUBLE) AS x1, CAST(590 AS DOUBLE) AS y1 FROM {q_pages}
  UNION ALL SELECT page_id, CAST(40 AS DOUBLE), CAST(40 AS DOUBLE), CAST(220 AS DOUBLE), CAST(160 AS DOUBLE) FROM {q_pages} WHERE page_id % 2 = 0""",
}
PAGE = ["page_id"]


def _items(spark, d):
    point = lambda i: F.when(F.col(f"p{i}x").isNotNull(), F.struct(F.col(f"p{i}x").alias("x"), F.col(f"p{i}y").alias("y")))
    f = proofs.frame(spark, d, "q_items")
    return f.select("page_id", "path_id", "item_id", "op", F.array_compact(F.array(*[point(i) for i in (1, 2, 3, 4)])).alias("pts"), "stroked", "width")


_ENDS = """, e AS (SELECT *, least(p1x, p2x, p3x, p4x) AS x0, least(p1y, p2y, p3y, p4y) AS y0, greatest(p1x, p2x, p3x, p4x) AS x1, greatest(p1y, p2y, p3y, p4y) AS y1, p1x AS ax, p1y AS ay,
  CASE WHEN op IN ('l', 're') THEN p2x ELSE p4x END AS ex, CASE WHEN op IN ('l', 're') THEN p2y ELSE p4y END AS ey FROM q_items)"""


def path_primitives(spark, d):
    return paths.primitives(_items(spark, d), PAGE)[0]


PRIMITIVE_SQL = proofs.with_tables(
    "q_items",
    _ENDS
    + """, o AS (SELECT *, CASE WHEN stroked THEN width / 2 ELSE 0 END AS pad, CASE WHEN op = 'l' AND abs(ay - ey) < 0.3 AND abs(ax - ex) > 1 THEN 'H' WHEN op = 'l' AND abs(ax - ex) < 0.3 AND abs(ay - ey) > 1 THEN 'V' END AS orient FROM e)
SELECT page_id, path_id, item_id, x0 - pad AS x0, y0 - pad AS y0, x1 + pad AS x1, y1 + pad AS y1, width, orient, CASE orient WHEN 'H' THEN (ay + ey) / 2 WHEN 'V' THEN (ax + ex) / 2 END AS coord,
  CASE orient WHEN 'H' THEN x0 WHEN 'V' THEN y0 END AS lo, CASE orient WHEN 'H' THEN x1 WHEN 'V' THEN y1 END AS hi FROM o""",
)
_SEGMENTS = (
    _ENDS
    + """, seg AS (SELECT page_id, path_id, 'H' AS orient, (ay + ey) / 2 AS coord, x0 AS lo, x1 AS hi FROM e WHERE op = 'l' AND abs(ay - ey) < greatest(0.3, 0.002 * (abs(ax - ex) + abs(ay - ey)))
 UNION ALL SELECT page_id, path_id, 'V', (ax + ex) / 2, y0, y1 FROM e WHERE op = 'l' AND abs(ax - ex) < greatest(0.3, 0.002 * (abs(ax - ex) + abs(ay - ey)))
 UNION ALL SELECT page_id, path_id, o, CASE WHEN o = 'H' THEN CASE WHEN s = 0 THEN y0 ELSE y1 END ELSE CASE WHEN s = 0 THEN x0 ELSE x1 END END, CASE WHEN o = 'H' THEN x0 ELSE y0 END, CASE WHEN o = 'H' THEN x1 ELSE y1 END
  FROM (SELECT *, list_sort([p1x, p2x, p3x, p4x]) AS qx, list_sort([p1y, p2y, p3y, p4y]) AS qy FROM e) q, (VALUES ('H'), ('V')) AS a(o), (VALUES (0), (1)) AS b(s)
  WHERE op = 're' OR (op = 'qu' AND qx[2] - qx[1] < 0.3 AND qx[4] - qx[3] < 0.3 AND qy[2] - qy[1] < 0.3 AND qy[4] - qy[3] < 0.3))"""
)


def path_segments(spark, d):
    return paths.segments(_items(spark, d), PAGE)


SEGMENT_SQL = proofs.with_tables("q_items", _SEGMENTS + " SELECT * FROM seg")
_FRAMES = (
    _SEGMENTS
    + """, b AS (SELECT page_id, path_id, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM e GROUP BY ALL),
n AS (SELECT b.*, (b.x0 + b.x1) / 2 BETWEEN -80 AND 880 AND (b.y0 + b.y1) / 2 BETWEEN -60 AND 660 AS near FROM b JOIN q_pages USING (page_id)),
k AS (SELECT * FROM n QUALIFY near OR NOT bool_or(near) OVER (PARTITION BY page_id)),
x AS (SELECT page_id, min(x0) AS ex0, min(y0) AS ey0, max(x1) AS ex1, max(y1) AS ey1 FROM k GROUP BY ALL),
g AS (SELECT page_id, orient, round_even(coord / 0.4, 0) AS bin, coord, lo, hi, max(hi) OVER (PARTITION BY page_id, orient, round_even(coord / 0.4, 0) ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM seg WHERE (page_id, path_id) IN (SELECT page_id, path_id FROM k)),
r AS (SELECT page_id, orient, avg(coord) AS c, sum(greatest(0, hi - greatest(lo, coalesce(reach, lo)))) AS cov FROM g GROUP BY page_id, orient, bin),
m AS (SELECT r.*, ex0, ey0, ex1, ey1, cov >= 0.6 * CASE WHEN orient = 'H' THEN ex1 - ex0 ELSE ey1 - ey0 END AS lng FROM r JOIN x USING (page_id)),
f AS (SELECT page_id, max(c) FILTER (orient = 'V' AND lng AND c < ex0 + 0.12 * (ex1 - ex0)) AS x0, min(c) FILTER (orient = 'V' AND lng AND c > ex1 - 0.12 * (ex1 - ex0)) AS x1, max(c) FILTER (orient = 'H' AND lng AND c < ey0 + 0.12 * (ey1 - ey0)) AS y0,
  min(c) FILTER (orient = 'H' AND lng AND c > ey1 - 0.12 * (ey1 - ey0)) AS low, min(c) FILTER (orient = 'H' AND cov >= 0.9 * (ex1 - ex0) AND c > ey1 - 0.2 * (ey1 - ey0)) AS title,
  list(c ORDER BY c DESC) FILTER (orient = 'H' AND lng AND c > ey1 - 0.12 * (ey1 - ey0)) AS ring FROM m GROUP BY page_id),
fr AS (SELECT page_id, policy, CASE WHEN ok THEN x0 END AS x0, CASE WHEN ok THEN y0 END AS y0, CASE WHEN ok THEN x1 END AS x1,
  CASE WHEN ok THEN CASE policy WHEN 'title_top' THEN coalesce(title, low) WHEN 'inner_ring' THEN coalesce(list_reduce(list_prepend([ring[1]], list_transform(ring[2:], lambda v: [v])), lambda a, v: CASE WHEN a[-1] - v[1] > 1 THEN a || v ELSE a END)[2], low) ELSE low END END AS y1,
  CASE WHEN ok THEN 'OK' ELSE 'FRAME_NOT_FOUND' END AS status FROM (SELECT *, x0 IS NOT NULL AND x1 IS NOT NULL AND y0 IS NOT NULL AND low IS NOT NULL AS ok FROM x LEFT JOIN f USING (page_id)) z, (VALUES ('innermost'), ('title_top'), ('inner_ring')) AS p(policy))"""
)


def frame_policies(spark, d):
    items, pages = _items(spark, d), proofs.frame(spark, d, "q_pages")
    return paths.page_frame(items, pages, PAGE, policy=paths.POLICIES).select("page_id", "policy", "x0", "y0", "x1", "y1", "status")


POLICY_SQL = proofs.with_tables("q_items q_pages", _FRAMES + " SELECT page_id, policy, x0, y0, x1, y1, status FROM fr")


def _drawing(spark, d):
    items, pages = _items(spark, d), proofs.frame(spark, d, "q_pages")
    frames = paths.page_frame(items, pages, PAGE).filter("status = 'OK'")
    return paths.drawing_items(items, frames, proofs.frame(spark, d, "q_areas"), PAGE)


def drawing_items(spark, d):
    return _drawing(spark, d)[0].select("page_id", "path_id", "item_id")


def dropped_paths(spark, d):
    return _drawing(spark, d)[1]


_DRAWING = _FRAMES + """, ff AS (SELECT page_id, x0 AS f0, y0 AS g0, x1 AS f1, y1 AS g1 FROM fr WHERE policy = 'innermost' AND status = 'OK'),
d0 AS (SELECT e.*, ff.* EXCLUDE (page_id), min(x0) OVER w AS bx0, min(y0) OVER w AS by0, max(x1) OVER w AS bx1, max(y1) OVER w AS by1, count(*) OVER w AS cnt, bool_and(op = 'l') OVER w AS st, abs(ax - ex) AS dx, abs(ay - ey) AS dy FROM e JOIN ff USING (page_id) WINDOW w AS (PARTITION BY page_id, path_id)),
d1 AS (SELECT *, CASE WHEN NOT (bx0 >= f0 - 0.5 AND by0 >= g0 - 0.5 AND bx1 <= f1 + 0.5 AND by1 <= g1 + 0.5) THEN 'frame_band' WHEN bx1 - bx0 > 0.9 * (f1 - f0) OR by1 - by0 > 0.9 * (g1 - g0) THEN 'frame_rule' END AS why,
  cnt > 1 AND st AND ax BETWEEN f0 - 0.5 AND f1 + 0.5 AND ex BETWEEN f0 - 0.5 AND f1 + 0.5 AND ay BETWEEN g0 - 0.5 AND g1 + 0.5 AND ey BETWEEN g0 - 0.5 AND g1 + 0.5 AND
  CASE WHEN dy < 0.3 THEN least(abs(ay - g0), abs(ay - g1)) >= 1 AND dx <= 0.9 * (f1 - f0) AND NOT (least(abs(ax - f0), abs(ax - f1), abs(ex - f0), abs(ex - f1)) < 1 AND sqrt(dx * dx + dy * dy) < 0.03 * least(f1 - f0, g1 - g0))
    WHEN dx < 0.3 THEN least(abs(ax - f0), abs(ax - f1)) >= 1 AND dy <= 0.9 * (g1 - g0) AND NOT (least(abs(ay - g0), abs(ay - g1), abs(ey - g0), abs(ey - g1)) < 1 AND sqrt(dx * dx + dy * dy) < 0.03 * least(f1 - f0, g1 - g0)) ELSE false END AS res FROM d0),
l1 AS (SELECT page_id, path_id, why || CASE WHEN bool_or(res) THEN '_split' ELSE '' END AS reason FROM d1 WHERE why IS NOT NULL GROUP BY page_id, path_id, why),
d2 AS (SELECT * REPLACE (min(x0) OVER w AS bx0, min(y0) OVER w AS by0, max(x1) OVER w AS bx1, max(y1) OVER w AS by1, count(*) OVER w AS cnt, bool_and(op = 'l') OVER w AS st) FROM d1 WHERE why IS NULL OR res WINDOW w AS (PARTITION BY page_id, path_id)),
d3 AS (SELECT *, st AND ((by1 - by0 < 0.6 AND bx1 - bx0 > 2 AND least(abs(by0 - g0), abs(by1 - g1)) < 1) OR (bx1 - bx0 < 0.6 AND by1 - by0 > 2 AND least(abs(bx0 - f0), abs(bx1 - f1)) < 1)) AS edge FROM d2),
ar AS (SELECT page_id, x0 - 0.6 AS a0, y0 - 0.6 AS b0, x1 + 0.6 AS a1, y1 + 0.6 AS b1 FROM q_areas),
d4 AS (SELECT d3.*, EXISTS (SELECT 1 FROM ar WHERE ar.page_id = d3.page_id AND (bx0 + bx1) / 2 BETWEEN a0 AND a1 AND (by0 + by1) / 2 BETWEEN b0 AND b1) AS central, EXISTS (SELECT 1 FROM ar WHERE ar.page_id = d3.page_id AND ax BETWEEN a0 AND a1 AND ay BETWEEN b0 AND b1) AS ia,
  EXISTS (SELECT 1 FROM ar WHERE ar.page_id = d3.page_id AND ex BETWEEN a0 AND a1 AND ey BETWEEN b0 AND b1) AS ib, EXISTS (SELECT 1 FROM ar WHERE ar.page_id = d3.page_id AND ax BETWEEN a0 AND a1 AND ay BETWEEN b0 AND b1 AND ex BETWEEN a0 AND a1 AND ey BETWEEN b0 AND b1) AS one FROM d3 WHERE NOT edge),
d5 AS (SELECT *, CASE WHEN central THEN cnt > 1 AND st AND (dx < 0.3 OR dy < 0.3) AND sqrt(dx * dx + dy * dy) > 2 AND NOT ia AND NOT ib ELSE true END AS fst FROM d4),
d6 AS (SELECT *, fst AND NOT CASE WHEN count(*) FILTER (fst) OVER (PARTITION BY page_id, path_id) > 1 THEN ia AND ib ELSE op = 'l' AND one END AS stay FROM d5)"""


def _drawing_sql(rest: str) -> str:
    return proofs.with_tables("q_items q_pages q_areas", _DRAWING + rest)


DRAWING_SQL = _drawing_sql(" SELECT page_id, path_id, item_id FROM d6 WHERE stay")
DROPPED_SQL = _drawing_sql(
    """ SELECT * FROM l1 UNION ALL SELECT DISTINCT page_id, path_id, 'frame_edge' FROM d3 WHERE edge
UNION ALL SELECT page_id, path_id, CASE WHEN bool_or(stay) THEN 'area_split' ELSE 'area' END FROM d6 GROUP BY page_id, path_id HAVING NOT bool_and(stay)"""
)

QUERIES = {
    "path_primitives": (path_primitives, PRIMITIVE_SQL), "path_segments": (path_segments, SEGMENT_SQL), "frame_policies": (frame_policies, POLICY_SQL), "drawing_items": (drawing_items, DRAWING_SQL),
    "dropped_paths": (dropped_paths, DROPPED_SQL),
}
