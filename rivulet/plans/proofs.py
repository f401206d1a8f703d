"""Queries on proofs: painted rules, approved placements, reviewed fields, removed operators, watermark words, caches.

The tables they read are derived in SQL that both engines run; ``{name}`` stands for a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators import cache, graph, proofs
from rivulet.sources import views as V

TABLES = {
    "p_rules": """SELECT *, CASE WHEN k % 5 = 0 THEN CASE WHEN k % 2 = 0 THEN 99.74 ELSE 99.76 END END AS clip_end, CASE WHEN k % 5 = 0 THEN 100.0 END AS original, CASE WHEN k % 5 = 0 THEN 0.5 END AS original_width
  FROM (SELECT CAST(floor(o_orderkey / 20) AS BIGINT) AS page_id, o_orderkey AS rule_id, o_orderkey AS k, CAST((37 * o_orderkey) % 480 AS DOUBLE) AS px, CAST((53 * o_orderkey) % 380 AS DOUBLE) AS py,
    CAST((37 * o_orderkey) % 480 + CASE WHEN o_orderkey % 2 = 1 THEN 40 + o_orderkey % 60 ELSE 0 END AS DOUBLE) AS qx, CAST((53 * o_orderkey) % 380 + CASE WHEN o_orderkey % 2 = 1 THEN 0 ELSE 30 + o_orderkey % 60 END AS DOUBLE) AS qy,
    CAST(0.5 + (o_orderkey % 3) * 0.25 AS DOUBLE) AS width, CAST(0.1 * (o_orderkey % 4) AS DOUBLE) AS r, CAST(0.2 AS DOUBLE) AS g, CAST(0.6 AS DOUBLE) AS b, CAST(o_orderkey % 3 AS INT) AS cap FROM {orders}) t""",
    "p_lines": """SELECT page_id, k * 100 + n * 6 AS seqno, CASE WHEN n % 2 = 1 THEN px ELSE qx END + d AS ax, CASE WHEN n % 2 = 1 THEN py ELSE qy END - d AS ay, CASE WHEN n % 2 = 1 THEN qx ELSE px END + d AS bx,
    CASE WHEN n % 2 = 1 THEN qy ELSE py END AS by, width + CASE WHEN p % 13 = 0 THEN 0.05 ELSE 0 END AS width, r, g + CASE WHEN p % 17 = 0 THEN 0.02 ELSE 0 END AS g, b, cap + CASE WHEN p % 19 = 0 THEN 1 ELSE 0 END AS cap
  FROM (SELECT t.*, l_linenumber AS n, l_partkey AS p, CASE l_partkey % 4 WHEN 1 THEN 0.02 WHEN 2 THEN 0.04 ELSE 0 END AS d FROM {p_rules} t JOIN {lineitem} l ON l.l_orderkey = t.k WHERE l_linenumber <= 3 AND l_partkey % 3 > 0) u""",
    "p_groups": """SELECT page_id, group_id, k, x0, y0, x0 + 80 AS x1, y0 + 80 AS y1, 10 + x0 * 2 AS dst_x, 20 + y0 AS dst_y, CAST(CASE WHEN k % 3 = 0 THEN 0.5 ELSE 1 END AS DOUBLE) AS scale
  FROM (SELECT CAST(floor(o_orderkey / 20) AS BIGINT) AS page_id, o_orderkey AS group_id, o_orderkey AS k, CAST(o_orderkey % 20 % 5 * 100 AS DOUBLE) AS x0, CAST(floor(o_orderkey % 20 / 5) * 100 AS DOUBLE) AS y0 FROM {orders}) t""",
    "p_places": """SELECT DISTINCT page_id, k * 10 + n AS place_id, x0 + s AS x0, y0 AS y0, x1 + s AS x1, y1, t_x0, t_y0, t_x0 + 40 AS t_x1, t_y0 + 80 AS t_y1, scale FROM (
  SELECT page_id, k, l_linenumber AS n, CASE WHEN k % 11 = 0 AND l_linenumber = 2 THEN 15 ELSE 0 END AS s, x0 + CASE WHEN l_linenumber % 2 = 0 THEN 40 ELSE 0 END AS x0, y0, x0 + CASE WHEN l_linenumber % 2 = 0 THEN 80 ELSE 40 END AS x1,
    y0 + 80 AS y1, dst_x + CASE WHEN l_linenumber % 2 = 0 THEN 40 ELSE 0 END + CASE WHEN k % 7 = 3 THEN 0.05 WHEN k % 7 = 4 THEN 0.02 ELSE 0 END AS t_x0, dst_y AS t_y0, scale + CASE WHEN k % 7 = 1 AND l_linenumber = 1 THEN 0.1 ELSE 0 END AS scale
  FROM {p_groups} g JOIN {lineitem} l ON l.l_orderkey = g.k WHERE l_linenumber <= 2) t""",
    "p_ledgers": """SELECT c_custkey AS ledger_id, CASE WHEN c_custkey % 41 = 0 THEN 'fields-v0' ELSE 'fields-v1' END AS schema, concat('s', c_custkey % 700) AS source_sha, concat('s', CASE WHEN c_custkey % 37 = 0 THEN 0 ELSE c_custkey % 700 END) AS job_source_sha,
  c_custkey % 4 AS rotation, CASE WHEN c_custkey % 31 = 0 THEN 9 ELSE c_custkey % 4 END AS job_rotation, concat('e', c_custkey % 700) AS entries, concat('m', c_custkey % 700) AS model, CASE WHEN c_custkey % 29 = 0 THEN 'x' ELSE concat('m', c_custkey % 700) END AS job_model,
  'title' AS title, 'title' AS job_title, CASE WHEN c_custkey % 2 = 0 THEN 'mm' END AS unit, CASE WHEN c_custkey % 2 = 0 THEN 'mm' END AS job_unit FROM {customer}""",
    "p_reviews": """SELECT concat('s', k) AS source_sha, CASE WHEN k % 23 = 0 THEN ' ' ELSE 'somebody' END AS reviewer, CASE WHEN k % 19 = 0 THEN 'OPEN' ELSE 'PASS_VISUAL_FIELD_COMPARISON' END AS status, concat('e', CASE WHEN k % 17 = 0 THEN -1 ELSE k END) AS entries,
  concat('m', k) AS model, CASE WHEN k % 13 = 0 THEN 'other' ELSE 'title' END AS title, CASE WHEN k % 2 = 0 THEN 'mm' END AS unit
  FROM (SELECT c_custkey % 700 AS k, c_custkey AS c FROM {customer} WHERE c_custkey <= 700 OR c_custkey % 43 = 0) t WHERE k % 11 > 0""",
    "p_regions": """SELECT c_custkey AS ledger_id, r AS name, false AS field, true AS reviewed, CAST(0 AS DOUBLE) AS x0, CAST(0 AS DOUBLE) AS y0, CAST(CASE WHEN c_custkey % 47 = 0 THEN 50 ELSE 100 END AS DOUBLE) AS x1, CAST(40 AS DOUBLE) AS y1,
  'h' AS sha, CASE WHEN c_custkey % 53 = 0 THEN 'g' ELSE 'h' END AS page_sha FROM {customer}, (SELECT 'tolerance' AS r UNION ALL SELECT 'identity') n WHERE NOT (c_custkey % 59 = 0 AND r = 'identity')
  UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 61 = 0 THEN 'colour' ELSE 'sheet' END, true, c_custkey % 67 > 0, CAST(200 AS DOUBLE), CAST(0 AS DOUBLE), CAST(230 AS DOUBLE), CAST(20 AS DOUBLE), 'h', 'h' FROM {customer} WHERE c_custkey % 3 = 0
  UNION ALL SELECT c_custkey, 'identity', false, true, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(9 AS DOUBLE), CAST(9 AS DOUBLE), 'h', 'h' FROM {customer} WHERE c_custkey % 71 = 0""",
    "p_clips": """SELECT c_custkey AS ledger_id, 'tolerance' AS kind, CAST(5 AS DOUBLE) AS x0, CAST(5 AS DOUBLE) AS y0, CAST(90 AS DOUBLE) AS x1, CAST(30 AS DOUBLE) AS y1 FROM {customer} WHERE c_custkey % 73 > 0
  UNION ALL SELECT c_custkey, 'tolerance', CAST(5 AS DOUBLE), CAST(5 AS DOUBLE), CAST(9 AS DOUBLE), CAST(9 AS DOUBLE) FROM {customer} WHERE c_custkey % 79 = 0
  UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'excluded' ELSE 'carried' END, CAST(CASE WHEN c_custkey % 5 = 0 THEN 220 ELSE 230 END AS DOUBLE), CAST(0 AS DOUBLE), CAST(250 AS DOUBLE), CAST(9 AS DOUBLE) FROM {customer} WHERE c_custkey % 6 = 0 OR c_custkey % 9 = 0""",
    "p_ops": "SELECT l_suppkey AS doc, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_returnflag) - 1 AS idx, concat(l_returnflag, ' ', CAST(l_partkey AS STRING)) AS op, l_returnflag = 'A' AND l_linenumber = 2 AS gone FROM {lineitem}",
    "p_removed": "SELECT doc, idx FROM {p_ops} WHERE gone UNION ALL SELECT doc, min(idx) FROM {p_ops} WHERE gone AND doc % 11 = 5 GROUP BY doc",
    "p_out": """SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY idx) - 1 AS idx, CASE WHEN doc % 5 = 1 AND idx % 97 = 41 THEN 'changed' ELSE op END AS op FROM {p_ops} WHERE NOT gone AND NOT (doc % 5 = 2 AND idx = 30 + doc % 400)
  UNION ALL SELECT doc, 100000000, 'more' FROM {p_ops} WHERE doc % 5 = 3 GROUP BY doc""",
    "p_words": """SELECT CAST(floor(p_partkey / 50) AS BIGINT) AS page_id, p_partkey AS pos, CAST((137 * p_partkey) % 400 AS DOUBLE) AS x0, CAST((59 * p_partkey) % 90 AS DOUBLE) AS y0, CAST((137 * p_partkey) % 400 + 6 AS DOUBLE) AS x1,
  CAST((59 * p_partkey) % 90 + 8 AS DOUBLE) AS y1, CASE WHEN p_partkey % 17 = 5 THEN 'a SAMPLE here' WHEN p_partkey % 3 = 0 THEN 'S' WHEN p_partkey % 3 = 1 THEN 'E' ELSE 'word' END AS text FROM {part}""",
}


def _need(name: str, seen: list[str]) -> list[str]:
    for n in re.findall(r"\{(\w+)\}", TABLES[name]):
        if n in TABLES and n not in seen:
            _need(n, seen)
    seen.append(name)
    return seen


def frame(spark, d: str, name: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """The table ``name``; ``tables`` stand in for those of the folder."""
    given = tables or {}
    parts = {n: (frame(spark, d, n, tables) if n in TABLES else given[n] if n in given else V.table(spark, d, n)) for n in set(re.findall(r"\{(\w+)\}", TABLES[name]))}
    return spark.sql(TABLES[name], **parts)


def with_tables(names: str, rest: str) -> str:
    order: list[str] = []
    for n in names.split():
        if n not in order:
            _need(n, order)
    plain = lambda s: re.sub(r"\{(\w+)\}", r"\1", s)
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({plain(TABLES[n])})" for n in order) + "\n" + rest


def rule_visibility(spark, d):
    lines = frame(spark, d, "p_lines").withColumn("caps", F.array("cap"))
    return proofs.rule_visibility(frame(spark, d, "p_rules"), lines, ["page_id"])


VISIBILITY_SQL = with_tables(
    "p_rules p_lines",
    """, m AS (SELECT r.page_id, r.rule_id, l.seqno, abs(l.width - r.width) < 0.03 AND abs(l.r - r.r) < 0.03 AND abs(l.g - r.g) < 0.03 AND abs(l.b - r.b) < 0.03 AND l.cap = r.cap AS alike
  FROM p_rules r JOIN p_lines l ON l.page_id = r.page_id AND ((abs(ax - px) < 0.03 AND abs(ay - py) < 0.03 AND abs(bx - qx) < 0.03 AND abs(l."by" - qy) < 0.03) OR (abs(bx - px) < 0.03 AND abs(l."by" - py) < 0.03 AND abs(ax - qx) < 0.03 AND abs(ay - qy) < 0.03))),
c AS (SELECT *, count(*) OVER (PARTITION BY page_id, seqno) AS owners FROM m),
a AS (SELECT page_id, rule_id, count(*) AS paths, count(*) FILTER (alike) AS alike, count(*) FILTER (owners > 1) AS shared, max(seqno) - min(seqno) > 10 AS apart FROM c GROUP BY ALL),
o AS (SELECT r.page_id, r.rule_id, coalesce(paths, 0) AS paths, CASE WHEN clip_end < original - original_width / 2 - 0.005 AND apart THEN 1 ELSE 0 END AS masked, coalesce(alike, 0) AS alike, coalesce(shared, 0) AS shared FROM p_rules r LEFT JOIN a USING (page_id, rule_id))
SELECT *, paths - masked AS visible, paths - masked = 1 AND alike = paths AND shared = 0 AS passed FROM o""",
)


def approved_placements(spark, d):
    return proofs.approved_placements(frame(spark, d, "p_groups").drop("k"), frame(spark, d, "p_places"), ["page_id"])


APPROVED_SQL = with_tables(
    "p_groups p_places",
    """, m AS (SELECT g.page_id, g.group_id, p.place_id, p.x0, p.y0, p.x1, p.y1, t_x0, t_y0, p.scale FROM p_groups g JOIN p_places p ON p.page_id = g.page_id AND p.x0 >= g.x0 AND p.y0 >= g.y0 AND p.x1 <= g.x1 AND p.y1 <= g.y1),
u AS (SELECT page_id, group_id, min(x0) AS a, min(y0) AS b, max(x1) AS c, max(y1) AS e, min(t_x0) AS tx, min(t_y0) AS ty, min(scale) AS lo, max(scale) AS hi FROM m GROUP BY ALL),
f AS (SELECT g.page_id, g.group_id, unnest(list_filter([CASE WHEN lo IS NULL THEN 'missing' END, CASE WHEN abs(lo - scale) >= 1e-6 OR abs(hi - scale) >= 1e-6 THEN 'scale' END,
  CASE WHEN abs(a - x0) >= 0.03 OR abs(b - y0) >= 0.03 OR abs(c - x1) >= 0.03 OR abs(e - y1) >= 0.03 THEN 'source' END, CASE WHEN abs(tx - dst_x) >= 0.03 OR abs(ty - dst_y) >= 0.03 THEN 'target' END], lambda x: x IS NOT NULL)) AS finding
  FROM p_groups g LEFT JOIN u USING (page_id, group_id))
SELECT * FROM f UNION ALL SELECT DISTINCT page_id, NULL, 'foreign' FROM p_places WHERE (page_id, place_id) NOT IN (SELECT page_id, place_id FROM m)""",
)


def field_findings(spark, d):
    return proofs.field_findings(*[frame(spark, d, n) for n in ("p_ledgers", "p_reviews", "p_regions", "p_clips")], "fields-v1")


FIELDS_SQL = with_tables(
    "p_ledgers p_reviews p_regions p_clips",
    """, v AS (SELECT source_sha, count(*) AS n, min(reviewer) AS reviewer, min(status) AS status, min(entries) AS ve, min(model) AS vm, min(title) AS vt, min(unit) AS vu FROM p_reviews GROUP BY source_sha),
l AS (SELECT l.*, coalesce(n, 0) AS n, v.reviewer, v.status, ve, vm, vt, vu FROM p_ledgers l LEFT JOIN v USING (source_sha)),
a AS (SELECT ledger_id, unnest([CASE WHEN schema <> 'fields-v1' THEN 'schema' END, CASE WHEN source_sha <> job_source_sha THEN 'source' END, CASE WHEN rotation <> job_rotation THEN 'rotation' END,
  CASE WHEN n = 0 THEN 'review missing' WHEN n > 1 THEN 'review double' END, CASE WHEN n = 1 AND trim(reviewer) = '' THEN 'reviewer' END, CASE WHEN n = 1 AND status <> 'PASS_VISUAL_FIELD_COMPARISON' THEN 'status' END,
  CASE WHEN n = 1 AND entries <> ve THEN 'entries' END, CASE WHEN (n = 1 AND model IS DISTINCT FROM vm) OR model IS DISTINCT FROM job_model THEN 'model differs' END,
  CASE WHEN (n = 1 AND title IS DISTINCT FROM vt) OR title IS DISTINCT FROM job_title THEN 'title differs' END, CASE WHEN (n = 1 AND unit IS DISTINCT FROM vu) OR unit IS DISTINCT FROM job_unit THEN 'unit differs' END]) AS finding FROM l
 UNION ALL SELECT ledger_id, CASE WHEN k IS NULL THEN 'region missing ' || r WHEN k > 1 THEN 'region double ' || r END FROM p_ledgers CROSS JOIN (VALUES ('tolerance'), ('identity')) AS w(r)
  LEFT JOIN (SELECT ledger_id, name AS r, count(*) AS k FROM p_regions WHERE NOT field GROUP BY ALL) c USING (ledger_id, r)
 UNION ALL SELECT ledger_id, unnest([CASE WHEN (field AND name NOT IN ('model', 'title', 'unit', 'sheet', 'scale_text', 'size')) OR (NOT field AND name NOT IN ('tolerance', 'identity')) THEN 'region unknown ' || name END,
  CASE WHEN sha <> page_sha THEN 'fingerprint ' || name END, CASE WHEN field AND NOT reviewed THEN 'unreviewed ' || name END]) FROM p_regions
 UNION ALL SELECT ledger_id, CASE WHEN coalesce(g, 0) <> 1 THEN 'tolerance groups' WHEN NOT (a >= r.x0 AND b >= r.y0 AND c <= r.x1 AND e <= r.y1) THEN 'not covered' END FROM p_ledgers
  LEFT JOIN (SELECT ledger_id, count(*) AS g, min(x0) AS a, min(y0) AS b, max(x1) AS c, max(y1) AS e FROM p_clips WHERE kind = 'tolerance' GROUP BY ledger_id) t USING (ledger_id)
  LEFT JOIN (SELECT * FROM p_regions WHERE name = 'tolerance') r USING (ledger_id)
 UNION ALL SELECT r.ledger_id, kind || ' ' || name FROM p_regions r JOIN p_clips c USING (ledger_id) WHERE field AND kind <> 'tolerance' AND least(r.x1, c.x1) > greatest(r.x0, c.x0) AND least(r.y1, c.y1) > greatest(r.y0, c.y0))
SELECT DISTINCT ledger_id, finding FROM a WHERE finding IS NOT NULL""",
)


def removal_proof(spark, d):
    """Line items are dealt by document once, in as many tasks as their count asks for; every list is made of that one shuffle."""
    items = V.table(spark, d, "lineitem")
    n = max(-(-items.count() // V.ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = items.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag").repartition(n, "l_suppkey")
    return proofs.removal_proof(*[frame(spark, d, name, {"lineitem": dealt}) for name in ("p_ops", "p_removed", "p_out")], "doc", 64)


REMOVAL_SQL = with_tables(
    "p_ops p_removed p_out",
    """, k AS (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY idx) - 1 AS place, sha256(op) AS h FROM p_ops WHERE (doc, idx) NOT IN (SELECT doc, idx FROM p_removed)),
o AS (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY idx) - 1 AS place, sha256(op) AS h FROM p_out),
x AS (SELECT coalesce(k.doc, o.doc) AS doc, min(coalesce(k.place, o.place)) AS first_difference FROM k FULL JOIN o ON k.doc = o.doc AND k.place = o.place WHERE k.h IS DISTINCT FROM o.h GROUP BY ALL),
c AS (SELECT doc, place // 64 AS piece, sha256(string_agg(h, '' ORDER BY place)) AS h FROM k GROUP BY ALL),
s AS (SELECT doc, list_reduce(list_prepend('', list(h ORDER BY piece)), lambda acc, y: sha256(acc || y)) AS retained_sha256 FROM c GROUP BY doc),
n AS (SELECT doc, count(*) AS n_source FROM p_ops GROUP BY doc), r AS (SELECT doc, count(*) AS asked, count(DISTINCT idx) AS n_removed FROM p_removed GROUP BY doc), p AS (SELECT doc, count(*) AS n_output FROM p_out GROUP BY doc)
SELECT doc, n_source, coalesce(n_removed, 0) AS n_removed, n_output, first_difference IS NULL AND coalesce(asked, 0) = coalesce(n_removed, 0) AS equal, first_difference, retained_sha256
FROM n LEFT JOIN r USING (doc) LEFT JOIN p USING (doc) LEFT JOIN x USING (doc) LEFT JOIN s USING (doc)""",
)


def watermark_words(spark, d):
    return proofs.watermark_words(frame(spark, d, "p_words"), ["page_id"], ["SAMPLE"], ["S", "E"])


WATERMARK_SQL = with_tables(
    "p_words",
    """, w AS (SELECT *, contains(text, 'SAMPLE') AS seed FROM p_words),
e AS (SELECT a.page_id, a.pos AS a, b.pos AS b FROM w a JOIN w b ON a.page_id = b.page_id AND b.text IN ('S', 'E') AND (a.seed OR (a.text IN ('S', 'E') AND a.pos < b.pos))
  AND a.x1 + 25 >= b.x0 AND b.x1 + 25 >= a.x0 AND a.y1 + 25 >= b.y0 AND b.y1 + 25 >= a.y0),
r(page_id, pos, step) AS (SELECT page_id, pos, 0 FROM w WHERE seed UNION SELECT r.page_id, e.b, step + 1 FROM r JOIN e ON e.page_id = r.page_id AND e.a = r.pos)
SELECT page_id, pos, min(step) AS step FROM r GROUP BY ALL""",
)


def cached_values(spark, d):
    """Half of the parts are in the cache, some of these entries damaged; all parts are asked for."""
    p = V.table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    inputs = ["p_partkey", "p_name", "p_size"]
    make = lambda df: df.withColumn("value", F.concat("p_name", F.lit("/"), F.col("p_size").cast("string")))
    path = f"{graph.shared_folder(spark)}/cache"
    old = cache.entries(make(p.filter("p_partkey % 2 = 0")), inputs, "value", "v1")
    old.withColumn("value", F.when(F.col("value").rlike("[05]$"), F.concat("value", F.lit("?"))).otherwise(F.col("value"))).write.parquet(path)
    cache.entries(make(p.filter("p_partkey % 2 = 1")), inputs, "value", "v0").write.mode("append").parquet(path)  # of another version
    return cache.cached(p, path, inputs, make, "value", "v1").select("p_partkey", "value", "hit")


CACHE_SQL = "SELECT p_partkey, p_name || '/' || p_size AS value, p_partkey % 2 = 0 AND p_size % 5 <> 0 AS hit FROM part"

QUERIES = {
    "rule_visibility": (rule_visibility, VISIBILITY_SQL), "approved_placements": (approved_placements, APPROVED_SQL), "field_findings": (field_findings, FIELDS_SQL),
    "removal_proof": (removal_proof, REMOVAL_SQL), "watermark_words": (watermark_words, WATERMARK_SQL), "cached_values": (cached_values, CACHE_SQL),
}
