"""DuckDB forms of queries whose result follows from an order: folds as recursive statements, cells around labels."""

from __future__ import annotations

from rivulet.plans.geometry import _FRAME
from rivulet.plans.sheets import CORNER_SQL
from rivulet.plans.texts import _COL
from rivulet.sources.views import with_views

PAGES = with_views("seg", _FRAME.replace("0.6 *", "0.5 *") + " SELECT page_id, paths FROM (SELECT page_id, count(*) AS paths FROM seg GROUP BY page_id HAVING count(*) >= 300) JOIN fr USING (page_id) WHERE found >= 1")

FRACTIONS = f"""WITH c AS ({CORNER_SQL}),
f AS (SELECT DISTINCT page_id, least(1.0, greatest(0.0, round_even(x0 / 800, 3))) AS x0, least(1.0, greatest(0.0, round_even(y0 / 600, 3))) AS y0, least(1.0, greatest(0.0, round_even(x1 / 800, 3))) AS x1, least(1.0, greatest(0.0, round_even(y1 / 600, 3))) AS y1 FROM c)
SELECT * FROM f a WHERE NOT EXISTS (SELECT 1 FROM f b WHERE b.page_id = a.page_id AND (b.x0, b.y0, b.x1, b.y1) <> (a.x0, a.y0, a.x1, a.y1) AND b.x0 <= a.x0 AND b.y0 <= a.y0 AND b.x1 >= a.x1 AND b.y1 >= a.y1)"""

BODY = (
    _COL
    + """, d AS (SELECT p_partkey % 9 AS page_id, p_partkey % 17 AS colour, p_partkey, greatest(r, g, b) - least(r, g, b) < 0.10 AS neutral FROM c),
n AS (SELECT page_id, colour, count(*) AS n, min(p_partkey) AS seen, bool_or(neutral) AS neutral FROM d GROUP BY ALL),
s AS (SELECT page_id, coalesce(sum(n) FILTER (neutral), 0) / sum(n) AS share FROM n GROUP BY page_id),
m AS (SELECT page_id, colour FROM n WHERE NOT neutral QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY n DESC, seen) = 1)
SELECT page_id, round_even(share, 6) AS neutral_share, CASE WHEN share < 0.15 THEN colour END AS body FROM s LEFT JOIN m USING (page_id)"""
)

ROWS = with_views(
    "word",
    """, w AS (SELECT id, word, CAST(pos % 10 AS DOUBLE) AS x, CAST(floor(pos / 10) * 3 AS DOUBLE) + (pos % 3) * 0.9 AS y FROM word),
ys AS (SELECT id, list(DISTINCT y ORDER BY y) AS ys FROM w GROUP BY id),
r(id, "row", y0) AS (SELECT id, 1, ys[1] FROM ys UNION ALL SELECT r.id, "row" + 1, list_filter(ys, lambda v: v - r.y0 >= 2.0)[1] FROM r JOIN ys USING (id) WHERE len(list_filter(ys, lambda v: v - r.y0 >= 2.0)) > 0),
k AS (SELECT w.*, r."row" FROM w ASOF JOIN r ON w.id = r.id AND w.y >= r.y0)
SELECT id, "row", string_agg(word, '  ' ORDER BY x, word) AS line FROM k GROUP BY id, "row\"""",
)

LABELS = with_views(
    "box rule",
    """, w AS (SELECT box_id // 20 AS page_id, box_id AS word_id, x0, y0, x1 + 4 AS x1, y1 + 4 AS y1, CASE box_id % 3 WHEN 0 THEN 'Model: ' WHEN 1 THEN 'Unit: ' ELSE '' END || box_id AS text FROM box),
l AS (SELECT page_id // 5 AS page_id, orient, coord, lo, hi FROM rule),
p AS (SELECT page_id, field, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y FROM w JOIN (VALUES ('model', 'Model'), ('unit', 'Unit'), ('sheet', 'Sheet')) AS v(field, label) ON contains(text, label) QUALIFY row_number() OVER (PARTITION BY page_id, field ORDER BY y0, x0, word_id) = 1),
c AS (SELECT p.page_id, p.field, coalesce(max(coord) FILTER (orient = 'V' AND coord <= x), -1e9) AS x0, coalesce(min(coord) FILTER (orient = 'V' AND coord > x), 1e9) AS x1, coalesce(max(coord) FILTER (orient = 'H' AND coord <= y), -1e9) AS y0, coalesce(min(coord) FILTER (orient = 'H' AND coord > y), 1e9) AS y1
  FROM p LEFT JOIN l ON l.page_id = p.page_id AND lo - 0.8 <= CASE WHEN orient = 'V' THEN y ELSE x END AND hi + 0.8 >= CASE WHEN orient = 'V' THEN y ELSE x END GROUP BY p.page_id, p.field),
t AS (SELECT c.page_id, field, string_agg(text, ' ' ORDER BY round_even((w.y0 + w.y1) / 2, 0), w.x0, text) AS t FROM c JOIN w ON w.page_id = c.page_id AND (w.x0 + w.x1) / 2 BETWEEN c.x0 AND c.x1 AND (w.y0 + w.y1) / 2 BETWEEN c.y0 AND c.y1 GROUP BY c.page_id, field),
v AS (SELECT page_id, field, trim(regexp_extract(t, '(?s)^[^:：]*[:：](.*)$', 1)) AS value FROM t)
SELECT page_id, field, nullif(value, '') AS value, CASE WHEN value = '' THEN 'VALUE_NOT_TEXT_NEEDS_READ' END AS flag FROM v""",
)

_NEAR = "abs(y - {0} - ({1})) <= greatest(0.8, 0.12 * ({1}))"
_GOES, _TURNS = _NEAR.format("last", "pitch"), _NEAR.format("stray", "stray - last")
PITCHES = with_views(
    "seg",
    f""", v AS (SELECT page_id, orient, coord AS y, row_number() OVER (PARTITION BY page_id, orient ORDER BY coord) AS k FROM (SELECT DISTINCT page_id, orient, coord FROM seg)),
s(page_id, orient, k, first, last, pitch, n, good, stray, ended) AS (SELECT page_id, orient, k, y, y, NULL::DOUBLE, 1, 1, NULL::DOUBLE, NULL::STRUCT(f DOUBLE, l DOUBLE, p DOUBLE, n BIGINT) FROM v WHERE k = 1
 UNION ALL SELECT page_id, orient, k, CASE what WHEN 'turn' THEN last WHEN 'new' THEN last ELSE first END, CASE what WHEN 'wait' THEN last WHEN 'new' THEN stray ELSE y END,
  CASE what WHEN 'begin' THEN y - first WHEN 'turn' THEN stray - last WHEN 'new' THEN stray - last ELSE pitch END,
  CASE what WHEN 'begin' THEN 2 WHEN 'go' THEN n + 1 + (stray IS NOT NULL)::INT WHEN 'turn' THEN 3 WHEN 'new' THEN 2 ELSE n END, CASE what WHEN 'begin' THEN 2 WHEN 'go' THEN good + 1 WHEN 'turn' THEN 3 WHEN 'new' THEN 2 ELSE good END,
  CASE what WHEN 'wait' THEN y WHEN 'new' THEN y END, CASE WHEN what IN ('turn', 'new') AND good >= 3 THEN {{'f': first, 'l': last, 'p': pitch, 'n': n::BIGINT}} END
 FROM (SELECT s.page_id, s.orient, v.k, y, first, last, pitch, n, good, stray, CASE WHEN pitch IS NULL THEN 'begin' WHEN {_GOES} THEN 'go' WHEN stray IS NULL THEN 'wait' WHEN {_TURNS} THEN 'turn' ELSE 'new' END AS what
  FROM s JOIN v ON v.page_id = s.page_id AND v.orient = s.orient AND v.k = s.k + 1))
SELECT page_id, orient, ended.f AS first, ended.l AS last, ended.p AS pitch, ended.n AS n FROM s WHERE ended IS NOT NULL
UNION ALL SELECT page_id, orient, first, last, pitch, n::BIGINT FROM s JOIN (SELECT page_id, orient, max(k) AS k FROM v GROUP BY page_id, orient) e USING (page_id, orient, k) WHERE good >= 3""",
)
COMPACT = r"SELECT doc_id, sha256(regexp_replace(nfc_normalize(text), '[\s\x{0B}\x{85}\x{A0}\x{3000}]+', '', 'g')) AS digest FROM documents"

SQL = {"drawing_pages": PAGES, "corner_fractions": FRACTIONS, "body_colour": BODY, "visual_rows": ROWS, "label_fields": LABELS, "equal_pitch_runs": PITCHES, "compact_text": COMPACT}
