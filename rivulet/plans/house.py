"""Queries on the house sheet: right column, stacking, pulled members, placement checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import house, ledger, sheets
from rivulet.plans import proofs

PAGE = ["page_id"]
proofs.TABLES |= {
    "h_members": """SELECT CAST(floor(p / 72) AS BIGINT) AS page_id, blk AS block, p AS prim_id, x AS x0, y AS y0, x + CASE WHEN rule THEN 90 ELSE 2 + p % 11 * CASE WHEN blk IN (2, 6) AND p % 5 = 0 THEN 4 ELSE 1 END END AS x1,
  y + CASE WHEN rule THEN 0 ELSE 2 + p % 6 * CASE WHEN blk % 4 = 1 AND p % 7 = 0 THEN 9 ELSE 1 END END AS y1, rule FROM (
  SELECT p_partkey AS p, p_partkey % 9 AS blk, (p_partkey % 9 IN (3, 7) AND p_partkey % 2 = 0) AS rule, CAST(p_partkey % 9 % 3 * 150 + 20 + CASE WHEN p_partkey % 9 IN (3, 7) AND p_partkey % 2 = 0 THEN 0 ELSE (7 * p_partkey) % (60 + p_size) END AS DOUBLE) AS x,
    CAST(floor(p_partkey % 9 / 3) * 100 + (13 * p_partkey) % CASE WHEN p_partkey % 9 = 8 THEN 18 ELSE 60 + p_size % 30 END AS DOUBLE) AS y FROM {part}) t""",
    "h_rail": "SELECT DISTINCT page_id, block, block % 3 > 0 AND (page_id + block) % 4 > 0 AS in_rail FROM {h_members}",
    "h_content": "SELECT DISTINCT page_id, CAST(0 AS DOUBLE) AS x0, CAST(0 AS DOUBLE) AS y0, CAST(500 AS DOUBLE) AS x1, CAST(300 AS DOUBLE) AS y1 FROM {h_members}",
    "h_pulls": """SELECT DISTINCT page_id, CAST(1 AS INT) AS pull, CAST(0.3 AS DOUBLE) AS x0, CAST(0.1 AS DOUBLE) AS y0, CAST(0.75 AS DOUBLE) AS x1, CAST(0.5 AS DOUBLE) AS y1 FROM {h_members}
  UNION ALL SELECT DISTINCT page_id, CAST(2 AS INT), CAST(0.6 AS DOUBLE), CAST(0.2 AS DOUBLE), CAST(1 AS DOUBLE), CAST(0.9 AS DOUBLE) FROM {h_members} WHERE page_id % 2 = 0""",
    "h_places": """SELECT page_id, place_id, kind, k, CAST(10 AS DOUBLE) AS s_x0, CAST(10 AS DOUBLE) AS s_y0, CAST(CASE WHEN k % 31 = 0 THEN 900 ELSE 300 END AS DOUBLE) AS s_x1, CAST(200 AS DOUBLE) AS s_y1, x0, y0, x0 + w AS x1, y0 + h AS y1 FROM (
  SELECT CAST(floor(o_orderkey / 6) AS BIGINT) AS page_id, o_orderkey AS place_id, o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN 'table' WHEN 1 THEN 'performance' WHEN 2 THEN 'projection' WHEN 3 THEN 'tolerance' ELSE 'view' END AS kind,
    CAST(CASE o_orderkey % 6 WHEN 0 THEN 530 WHEN 1 THEN 530 WHEN 2 THEN 790 WHEN 3 THEN 405 WHEN 4 THEN 40 ELSE 200 END - CASE WHEN o_orderkey % 13 = 0 THEN 60 ELSE 0 END AS DOUBLE) AS x0,
    CAST(CASE o_orderkey % 6 WHEN 0 THEN 30 WHEN 1 THEN 200 WHEN 2 THEN 520 WHEN 3 THEN 460 WHEN 4 THEN 60 ELSE 100 END + CASE WHEN o_orderkey % 17 = 0 THEN 230 ELSE 0 END AS DOUBLE) AS y0,
    CAST(CASE o_orderkey % 6 WHEN 2 THEN 20 WHEN 3 THEN 80 ELSE 150 + o_orderkey % 60 END AS DOUBLE) AS w, CAST(CASE o_orderkey % 6 WHEN 2 THEN 30 WHEN 3 THEN 60 ELSE 120 + o_orderkey % 70 END AS DOUBLE) AS h FROM {orders}) t""",
    "h_ink": """SELECT page_id, place_id, x0, y0, x0 + 30 AS x1, y0 + 30 AS y1 FROM {h_places} UNION ALL SELECT page_id, place_id, x1 - 20, y1 - 20, x1, y1 FROM {h_places} WHERE kind NOT IN ('projection', 'tolerance')
  UNION ALL SELECT page_id, place_id, x0 + 40, y0 + 40, x0 + 120, y0 + 60 FROM {h_places} WHERE kind = 'view'""",
    "h_sheets": """SELECT DISTINCT page_id, CAST(0 AS DOUBLE) AS p_x0, CAST(0 AS DOUBLE) AS p_y0, CAST(842 AS DOUBLE) AS p_x1, CAST(595 AS DOUBLE) AS p_y1, CAST(20 AS DOUBLE) AS f_x0, CAST(20 AS DOUBLE) AS f_y0, CAST(822 AS DOUBLE) AS f_x1, CAST(575 AS DOUBLE) AS f_y1 FROM {h_places}""",
    "h_cells": """SELECT page_id, 'projection' AS cell, CAST(780 AS DOUBLE) AS x0, CAST(500 AS DOUBLE) AS y0, CAST(822 AS DOUBLE) AS x1, CAST(575 AS DOUBLE) AS y1 FROM {h_sheets} UNION ALL SELECT page_id, 'tolerance', CAST(400 AS DOUBLE), CAST(450 AS DOUBLE), CAST(490 AS DOUBLE), CAST(575 AS DOUBLE) FROM {h_sheets}
  UNION ALL SELECT page_id, 'reserved', CAST(490 AS DOUBLE), CAST(450 AS DOUBLE), CAST(822 AS DOUBLE), CAST(575 AS DOUBLE) FROM {h_sheets} UNION ALL SELECT page_id, 'reserved', CAST(400 AS DOUBLE), CAST(450 AS DOUBLE), CAST(490 AS DOUBLE), CAST(575 AS DOUBLE) FROM {h_sheets}""",
    "h_headers": """SELECT page_id, place_id + 1000000000 AS header_id, x0 + CASE WHEN k % 5 = 0 THEN 1 WHEN k % 5 = 1 THEN 3 ELSE 0 END AS x0, y0 - CASE WHEN k % 7 = 0 THEN 20 ELSE 10 END AS y0, x1 + CASE WHEN k % 11 = 0 THEN 60 ELSE 0 END AS x1, y0 + CASE WHEN k % 9 = 0 THEN 8 ELSE 0 END AS y1 FROM {h_places} WHERE kind = 'table'""",
}


def _f(spark, d, *names):
    return [proofs.frame(spark, d, n) for n in names]


_FACTS = """, bx AS (SELECT page_id, block, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM h_members GROUP BY ALL),
ft AS (SELECT page_id, block, b.x0, b.y0, b.x1, b.y1, count(*) FILTER (rule AND m.x1 - m.x0 > 0.6 * (b.x1 - b.x0)) AS rules, avg((greatest(m.x1 - m.x0, m.y1 - m.y0) < 0.02 * 500)::INT) AS small, bool_or(m.y1 - m.y0 > 0.04 * 300) AS tall FROM h_members m JOIN bx b USING (page_id, block) GROUP BY ALL),
facts AS (SELECT page_id, block, x0, y0, x1, y1, rules, rules >= 4 AS "table", rules >= 4 OR small >= 0.95 OR NOT tall AS textual FROM ft)"""


def block_facts(spark, d):
    return house.block_facts(*_f(spark, d, "h_members", "h_content"), PAGE)


FACTS_SQL = proofs.with_tables("h_members", _FACTS + " SELECT * FROM facts")


def column_blocks(spark, d):
    return house.column_blocks(*_f(spark, d, "h_members", "h_rail", "h_content"), PAGE)


COLUMN_SQL = proofs.with_tables(
    "h_members h_rail",
    _FACTS
    + """, a AS (SELECT facts.*, in_rail FROM facts JOIN h_rail USING (page_id, block)),
nr AS (SELECT a.page_id, a.block, b.block AS other FROM a JOIN a b ON a.page_id = b.page_id AND a.block <> b.block AND a.in_rail AND least(a.x1 + 5, b.x1) > greatest(a.x0 - 5, b.x0) AND least(a.y1 + 5, b.y1) > greatest(a.y0 - 5, b.y0)),
bk(page_id, block) AS (SELECT page_id, block FROM a WHERE NOT in_rail OR NOT textual UNION SELECT nr.page_id, nr.block FROM bk JOIN nr ON nr.page_id = bk.page_id AND nr.other = bk.block),
gn AS (SELECT a.* FROM a JOIN bk USING (page_id, block) WHERE in_rail),
cp AS (SELECT DISTINCT t.page_id, t.block FROM a t JOIN gn g ON t.page_id = g.page_id WHERE t.in_rail AND (t.page_id, t.block) NOT IN (SELECT page_id, block FROM bk) AND t.rules < 4 AND t.y1 - t.y0 < 0.08 * 300
  AND least(t.x1, g.x1) - greatest(t.x0, g.x0) >= 0.5 * least(t.x1 - t.x0, g.x1 - g.x0) AND greatest(t.y0 - g.y1, g.y0 - t.y1) BETWEEN -2 AND 0.1 * 300),
al AS (SELECT * FROM bk UNION SELECT * FROM cp),
o AS (SELECT page_id, block, (page_id, block) IN (SELECT page_id, block FROM al) AS back FROM a WHERE in_rail)
SELECT page_id, block, NOT back OR bool_and(back) OVER (PARTITION BY page_id) AS stays FROM o""",
)


def pulled_members(spark, d):
    m, p, c = _f(spark, d, "h_members", "h_pulls", "h_content")
    return house.pulled(m, p, c, PAGE).select("page_id", "prim_id", "pull")


PULLED_SQL = proofs.with_tables(
    "h_members h_pulls",
    " SELECT m.page_id, prim_id, min(pull) AS pull FROM h_members m LEFT JOIN h_pulls p ON p.page_id = m.page_id AND m.x0 >= p.x0 * 500 AND m.x1 <= p.x1 * 500 AND m.y0 >= p.y0 * 300 AND m.y1 <= p.y1 * 300 GROUP BY ALL",
)


def stacked_column(spark, d):
    members, rail, content = _f(spark, d, "h_members", "h_rail", "h_content")
    facts = house.block_facts(members, content, PAGE).join(rail.filter("in_rail"), [*PAGE, "block"]).withColumn("pulled", F.col("block") == 8)
    columns = content.select("page_id", F.lit(520.0).alias("c_x0"), F.lit(20.0).alias("c_y0"), F.lit(800.0).alias("c_x1"), F.lit(400.0).alias("c_y1"), F.when(F.col("page_id") % 2 == 0, F.lit(1.2)).alias("most"))
    return house.stacked(facts.select("page_id", "block", "x0", "y0", "x1", "y1", "table", "pulled"), columns, PAGE)


def placement_findings(spark, d):
    places, ink, sheets, cells, headers = _f(spark, d, "h_places", "h_ink", "h_sheets", "h_cells", "h_headers")
    return house.placement_findings(places.drop("k"), ink, sheets, cells, headers, PAGE)


FINDINGS_SQL = proofs.with_tables(
    "h_places h_ink h_sheets h_cells h_headers",
    """, p AS (SELECT h_places.*, p_x0, p_y0, p_x1, p_y1, f_x0, f_y0, f_x1, f_y1 FROM h_places JOIN h_sheets USING (page_id)),
i AS (SELECT h_ink.*, kind FROM h_ink JOIN h_places USING (page_id, place_id)),
ad AS (SELECT h.page_id, header_id, t.place_id FROM h_headers h JOIN h_places t ON t.page_id = h.page_id AND kind = 'table' AND abs(h.y1 - t.y0) <= 1 AND h.x0 >= t.x0 - 2 AND h.x1 <= t.x1 + 2)
SELECT page_id, place_id, NULL::BIGINT AS other, unnest(list_filter([CASE WHEN NOT (s_x0 >= p_x0 AND s_y0 >= p_y0 AND s_x1 <= p_x1 AND s_y1 <= p_y1) THEN 'source outside page' END, CASE WHEN NOT (x0 >= f_x0 AND y0 >= f_y0 AND x1 <= f_x1 AND y1 <= f_y1) THEN 'outside frame' END,
  CASE WHEN kind = 'projection' AND NOT (x0 >= 780 AND y0 >= 500 AND x1 <= 822 AND y1 <= 575) THEN 'not in its cell' WHEN kind = 'tolerance' AND NOT (x0 >= 400 AND y0 >= 450 AND x1 <= 490 AND y1 <= 575) THEN 'not in its cell' END,
  CASE WHEN kind = 'table' AND NOT (x0 >= 842 * 0.62 AND y0 < 595 * 0.4) THEN 'table not top right' END, CASE WHEN kind = 'performance' AND NOT (x0 >= 842 * 0.62 AND y0 >= 595 * 0.30) THEN 'performance not right middle' END], lambda x: x IS NOT NULL)) AS finding FROM p
UNION ALL SELECT DISTINCT i.page_id, place_id, NULL, 'enters reserved cell' FROM i JOIN h_cells c ON c.page_id = i.page_id AND cell = 'reserved' AND kind NOT IN ('projection', 'tolerance') AND least(i.x1, c.x1) > greatest(i.x0, c.x0) AND least(i.y1, c.y1) > greatest(i.y0, c.y0)
UNION ALL SELECT DISTINCT a.page_id, a.place_id, b.place_id, 'overlaps' FROM i a JOIN i b ON a.page_id = b.page_id AND a.place_id < b.place_id AND least(a.x1, b.x1) > greatest(a.x0, b.x0) AND least(a.y1, b.y1) > greatest(a.y0, b.y0)
UNION ALL SELECT page_id, NULL, NULL, 'performance not below table' FROM h_places GROUP BY page_id HAVING max(y1) FILTER (kind = 'table') >= min(y0) FILTER (kind = 'performance')
UNION ALL SELECT page_id, header_id, NULL, 'header outside frame' FROM h_headers JOIN h_sheets USING (page_id) WHERE NOT (x0 >= f_x0 AND y0 >= f_y0 AND x1 <= f_x1 AND y1 <= f_y1)
UNION ALL SELECT page_id, header_id, NULL, 'header adjoins no table' FROM h_headers WHERE (page_id, header_id) NOT IN (SELECT page_id, header_id FROM ad)
UNION ALL SELECT DISTINCT h.page_id, header_id, place_id, 'header covers ink' FROM h_headers h JOIN i ON i.page_id = h.page_id AND least(i.x1, h.x1) > greatest(i.x0, h.x0) AND least(i.y1, h.y1) > greatest(i.y0, h.y0) WHERE (h.page_id, header_id, place_id) NOT IN (SELECT page_id, header_id, place_id FROM ad)""",
)

proofs.TABLES |= {
    "h_events": """SELECT user_id AS job, event_id, CASE WHEN event_id % 2 = 0 THEN 'reserve' ELSE 'commit' END AS kind, concat('t', CAST(floor(event_id / 2) % 3 AS INT)) AS token, CAST(event_id % 5000 AS DOUBLE) AS sec FROM {events}""",
    "h_history": "SELECT CASE WHEN c_custkey % 19 = 0 THEN concat('r/', c_custkey) ELSE concat('r-', c_custkey) END AS record, CASE WHEN c_custkey % 17 = 0 THEN 'short' ELSE sha2(CAST(c_custkey AS STRING), 256) END AS sha, c_custkey % 3 AS attempts, c_custkey AS k FROM {customer}",
    "h_requests": "SELECT record, sha, CASE WHEN k % 5 = 0 THEN '  too short  ' ELSE 'the rules have changed' END AS reason, CASE WHEN k % 7 = 0 THEN ' ' WHEN k % 11 = 0 THEN NULL ELSE 'somebody' END AS operator FROM {h_history}",
    "h_words": """SELECT CAST(floor(p_partkey / 10) AS BIGINT) AS page_id, p_partkey AS word_id, CAST(500 + (37 * p_partkey) % 200 AS DOUBLE) AS x0, CAST(430 + (53 * p_partkey) % 120 AS DOUBLE) AS y0, CAST(540 + (37 * p_partkey) % 200 AS DOUBLE) AS x1,
  CAST(440 + (53 * p_partkey) % 120 AS DOUBLE) AS y1, CASE WHEN p_partkey % 7 = 0 THEN 'DRAWN' WHEN p_partkey % 7 = 1 THEN 'MODEL:' WHEN p_partkey % 7 = 2 AND p_size % 2 = 0 THEN 'TITLE' ELSE 'text' END AS text FROM {part}""",
    "h_lines": """SELECT CAST(floor(p_partkey / 10) AS BIGINT) AS page_id, 'H' AS orient, CAST(425 + (53 * p_partkey) % 120 AS DOUBLE) AS coord, CAST(490 AS DOUBLE) AS lo, CAST(CASE WHEN p_partkey % 3 = 0 THEN 560 ELSE 800 END AS DOUBLE) AS hi, CAST(0.5 AS DOUBLE) AS width FROM {part} WHERE p_partkey % 4 > 0
  UNION ALL SELECT CAST(floor(p_partkey / 10) AS BIGINT), 'V', CAST(496 + (37 * p_partkey) % 200 AS DOUBLE), CAST(420 AS DOUBLE), CAST(CASE WHEN p_partkey % 2 = 0 THEN 445 ELSE 580 END AS DOUBLE), CAST(0.25 AS DOUBLE) FROM {part}""",
}


def reserved_runs(spark, d):
    return ledger.reservations(_f(spark, d, "h_events")[0], "job", ["event_id"], "sec", 1500.0)


RESERVED_SQL = proofs.with_tables(
    "h_events",
    """, e AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY event_id) AS k FROM h_events),
r(job, k, event_id, kind, token, open, since, outcome) AS (SELECT job, k, event_id, kind, token, CASE WHEN kind = 'reserve' THEN token END, CASE WHEN kind = 'reserve' THEN sec END, CASE WHEN kind = 'reserve' THEN 'RUNNING' ELSE 'LOST' END FROM e WHERE k = 1
 UNION ALL SELECT e.job, e.k, e.event_id, e.kind, e.token, CASE WHEN e.kind = 'reserve' AND (open IS NULL OR e.sec - since >= 1500) THEN e.token WHEN e.kind = 'commit' AND open = e.token THEN NULL ELSE open END,
  CASE WHEN e.kind = 'reserve' AND (open IS NULL OR e.sec - since >= 1500) THEN e.sec WHEN e.kind = 'commit' AND open = e.token THEN NULL ELSE since END,
  CASE WHEN e.kind = 'reserve' THEN CASE WHEN open IS NULL OR e.sec - since >= 1500 THEN 'RUNNING' ELSE 'BUSY' END WHEN open = e.token THEN 'DONE' ELSE 'LOST' END FROM r JOIN e ON e.job = r.job AND e.k = r.k + 1)
SELECT job, event_id, kind, token, outcome FROM r""",
)


def audited_resets(spark, d):
    history, requests = _f(spark, d, "h_history", "h_requests")
    kept = history.filter("k % 13 > 0").select("record", "sha", "attempts")
    return ledger.audited_resets(requests, kept, ["record", "sha"])


RESETS_SQL = proofs.with_tables(
    "h_requests h_history",
    """ SELECT r.*, CASE WHEN length(coalesce(trim(reason), '')) < 12 THEN 'REASON_TOO_SHORT' WHEN coalesce(trim(operator), '') = '' THEN 'NO_OPERATOR' WHEN NOT regexp_full_match(record, '[A-Za-z0-9._-]+') THEN 'BAD_RECORD'
  WHEN NOT regexp_full_match(sha, '[0-9a-f]{64}') THEN 'BAD_DIGEST' WHEN h.attempts IS NULL THEN 'NO_HISTORY' ELSE 'RESET' END AS status, CASE WHEN status = 'RESET' THEN h.attempts END AS attempts
FROM h_requests r LEFT JOIN (SELECT * FROM h_history WHERE k % 13 > 0) h USING (record, sha)""",
).replace("sha2(CAST(c_custkey AS STRING), 256)", "sha256(CAST(c_custkey AS VARCHAR))")


def title_anchor(spark, d):
    words, lines = _f(spark, d, "h_words", "h_lines")
    pages = words.select("page_id", F.lit(842.0).alias("x1"), F.lit(595.0).alias("y1")).distinct()
    return sheets.title_anchor(words, lines, pages, ["DRAWN", "MODEL", "TITLE"], "TITLE", PAGE)


ANCHOR_SQL = proofs.with_tables(
    "h_words h_lines",
    """, o AS (SELECT *, contains(text, 'TITLE') AS t FROM h_words WHERE contains(text, 'DRAWN') OR contains(text, 'MODEL') OR contains(text, 'TITLE')),
a AS (SELECT page_id, y0 AS wy, (x0 + x1) / 2 AS wx FROM o QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY t DESC, y0, word_id) = 1),
tp AS (SELECT page_id, max(coord) AS ty FROM h_lines JOIN a USING (page_id) WHERE orient = 'H' AND coord BETWEEN wy - 15 AND wy + 0.5 AND lo - 0.8 <= wx AND hi + 0.8 >= wx GROUP BY page_id),
lw AS (SELECT page_id, min(x0) AS lx FROM o JOIN tp USING (page_id) WHERE y0 >= ty - 1 GROUP BY page_id),
lf AS (SELECT page_id, coord FROM h_lines JOIN tp USING (page_id) JOIN lw USING (page_id) WHERE orient = 'V' AND abs(coord - lx) <= 8 AND lo - 1 <= ty + 5 AND hi >= ty + 20 QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY abs(coord - lx), coord) = 1),
p AS (SELECT DISTINCT page_id FROM h_words)
SELECT page_id, CAST(coord - 0.25 / 2 - 0.3 AS DOUBLE) AS x0, CASE WHEN coord IS NOT NULL THEN CAST(ty - 0.5 / 2 - 0.3 AS DOUBLE) END AS y0, CASE WHEN coord IS NOT NULL THEN 842.0::DOUBLE END AS x1, CASE WHEN coord IS NOT NULL THEN 595.0::DOUBLE END AS y1,
  CASE WHEN wy IS NULL THEN 'NO_LABEL' WHEN ty IS NULL THEN 'NO_TOP_RULE' WHEN coord IS NULL THEN 'NO_LEFT_RULE' ELSE 'OK' END AS status FROM p LEFT JOIN a USING (page_id) LEFT JOIN tp USING (page_id) LEFT JOIN lf USING (page_id)""",
)

QUERIES = {
    "reserved_runs": (reserved_runs, RESERVED_SQL), "audited_resets": (audited_resets, RESETS_SQL), "title_anchor": (title_anchor, ANCHOR_SQL),
    "block_facts": (block_facts, FACTS_SQL), "column_blocks": (column_blocks, COLUMN_SQL), "pulled_members": (pulled_members, PULLED_SQL), "stacked_column": (stacked_column, None),
    "placement_findings": (placement_findings, FINDINGS_SQL),
}
