"""Queries on values, texts, bags, ledgers and choices."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions import colour as C
from rivulet.functions import text as T
from rivulet.operators import bags, blocks, frames, intervals, layout, ledger
from rivulet.sources import views as V
from rivulet.sources.files import packet, upsert
from rivulet.sources.views import with_views

# -- values ---------------------------------------------------------------------------------------------------------
_RGB = ["((p_partkey * 37) % 101) / 100.0", "((p_partkey * 53) % 101) / 100.0", "((p_partkey * 71) % 101) / 100.0"]


def _colours(spark, d):
    r, g, b = (f"CAST({x} AS DOUBLE) AS {n}" for x, n in zip(_RGB, "rgb"))
    return V.table(spark, d, "part").selectExpr("p_partkey", r, g, b)


_COL = "WITH c AS (SELECT p_partkey, " + ", ".join(f"(({x})::DOUBLE) AS {n}" for x, n in zip(_RGB, "rgb")) + " FROM part)"


def colour_class(spark, d):
    c = _colours(spark, d)
    r, g, b = F.col("r"), F.col("g"), F.col("b")
    k = C.key(r, g, b)
    return c.select(
        "p_partkey", *[C.classify(r, g, b, p).alias(n) for p, n in zip(C.PROFILES, ("legacy", "cyan", "nonblack"))], C.is_neutral(r, g, b).alias("neutral"),
        C.ink(r, g, b, F.array(F.struct(F.lit(0.37).alias("r"), F.lit(0.53).alias("g"), F.lit(0.71).alias("b"))), F.col("p_partkey") % 10 == 0).alias("ink"), F.concat_ws("/", k["r"], k["g"], k["b"]).isNotNull().alias("keyed"),
    )


COLOUR_SQL = (
    _COL
    + """, s AS (SELECT *, greatest(r, g, b) - least(r, g, b) < 0.1 AS n, least(r, g, b) >= 0.96 AS w FROM c)
SELECT p_partkey, CASE WHEN w THEN 'same' WHEN n OR (b > r + 0.08 AND b >= g) THEN 'blue' ELSE 'gold' END AS legacy,
CASE WHEN w THEN 'same' WHEN g > 0.6 AND b > 0.6 AND r < 0.4 THEN 'gold' ELSE 'blue' END AS cyan, CASE WHEN w THEN 'same' WHEN n THEN 'blue' ELSE 'gold' END AS nonblack, n AS neutral,
CASE WHEN p_partkey % 10 = 0 OR n OR (r = 0.37 AND g = 0.53 AND b = 0.71) THEN 'blue' ELSE 'gold' END AS ink, true AS keyed FROM s"""
)


def hex_recolour(spark, d):
    c = V.table(spark, d, "part").selectExpr("p_partkey", "concat('fill:#', lpad(lower(hex((p_partkey * 7919) % 16777216)), 6, '0'), ';stroke:#', substr(lpad(lower(hex((p_partkey * 131) % 4096)), 3, '0'), 1, 3), ';') AS style")
    return c.select("p_partkey", C.recolour_hex(F.col("style"), "nonblack-gold-v1", "#00f", "#fa0").alias("style"))


def _hexsql(h, orig):
    ch = ", ".join(f"('0x' || substr({h}, {i}, 2))::INTEGER / 255.0::DOUBLE" for i in (1, 3, 5))
    return f"CASE WHEN least({ch}) >= 0.96 THEN {orig} WHEN greatest({ch}) - least({ch}) < 0.1 THEN '#00f' ELSE '#fa0' END"


HEX_SQL = f"""WITH a AS (SELECT p_partkey, lpad(lower(to_hex((p_partkey * 7919) % 16777216)), 6, '0') AS x, lpad(lower(to_hex((p_partkey * 131) % 4096)), 3, '0') AS y FROM part),
b AS (SELECT *, y[1] || y[1] || y[2] || y[2] || y[3] || y[3] AS z FROM a)
SELECT p_partkey, 'fill:' || {_hexsql('x', "'#' || x")} || ';stroke:' || {_hexsql('z', "'#' || y")} || ';' AS style FROM b"""


def brand_model(spark, d):
    c = V.table(spark, d, "part").selectExpr("p_partkey", "concat(CASE p_partkey % 5 WHEN 0 THEN 'QX-' WHEN 1 THEN 'mv-' WHEN 2 THEN 'KL-  ' WHEN 3 THEN 'AQX-' ELSE '' END, p_brand) AS model")
    return c.select("p_partkey", T.strip_prefix(F.col("model"), ["QX-", "MV-", "KL-"]).alias("model"))


BRAND_SQL = """WITH c AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'QX-' WHEN 1 THEN 'mv-' WHEN 2 THEN 'KL-  ' WHEN 3 THEN 'AQX-' ELSE '' END || p_brand AS m FROM part)
SELECT p_partkey, CASE WHEN regexp_matches(trim(m), '^(?i)(QX-|MV-|KL-).') THEN ltrim(substr(trim(m), 4)) ELSE m END AS model FROM c"""


def field_split(spark, d):
    c = V.table(spark, d, "customer").selectExpr("c_custkey", "concat('label ', CAST(c_custkey % 7 AS STRING), CASE c_custkey % 3 WHEN 0 THEN ':' WHEN 1 THEN '：' ELSE ' ' END, ' ', c_name, ':x') AS t", "concat('Total ', CAST(c_custkey % 9 AS STRING), ' / page ', CAST(c_custkey % 4 AS STRING)) AS p")
    f = T.split_field(F.col("t"))
    return c.select("c_custkey", f["label"].alias("label"), f["value"].alias("value"), T.page_counter(F.col("p")).alias("counter"), T.file_safe(F.col("t"), ".pdf").alias("file"))


FIELD_SQL = """WITH c AS (SELECT c_custkey, 'label ' || (c_custkey % 7) || CASE c_custkey % 3 WHEN 0 THEN ':' WHEN 1 THEN '：' ELSE ' ' END || ' ' || c_name || ':x' AS t FROM customer),
p AS (SELECT *, regexp_extract(t, '^([^:：]*)', 1) AS l FROM c)
SELECT c_custkey, trim(l) AS label, CASE WHEN length(l) < length(t) THEN trim(substr(t, length(l) + 2)) END AS value, (c_custkey % 4) || '/' || (c_custkey % 9) AS counter, replace(t, '/', '_') || '.pdf' AS file FROM p"""


def tolerance_check(spark, d):
    v = lambda k: f"concat(CASE WHEN (p_partkey + {k}) % 11 = 0 THEN '' ELSE '±' END, '0.', CAST((p_partkey + {k}) % 50 AS STRING))"
    c = V.table(spark, d, "part").selectExpr("p_partkey", "CASE WHEN p_partkey % 13 = 0 THEN array('X.', 'X.X', 'X.XXX', 'X.XX') ELSE array('X.', 'X.X', 'X.XX', 'X.XXX') END AS tiers", f"array({', '.join(v(k) for k in range(4))}) AS vals")
    lines = F.transform(F.arrays_zip("tiers", "vals"), lambda z: T.tier_line(z["tiers"], z["vals"]))
    return c.select("p_partkey", T.tiers_valid(F.col("tiers"), F.col("vals")).alias("valid"), F.array_join(lines, ";").alias("lines"), T.clean(F.get("vals", 0)).alias("clean"))


TOL_SQL = """WITH c AS (SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN ['X.', 'X.X', 'X.XXX', 'X.XX'] ELSE ['X.', 'X.X', 'X.XX', 'X.XXX'] END AS t,
list_transform(range(4), lambda k: CASE WHEN (p_partkey + k) % 11 = 0 THEN '' ELSE '±' END || '0.' || ((p_partkey + k) % 50)) AS v FROM part)
SELECT p_partkey, p_partkey % 13 <> 0 AND len(list_filter(v, lambda x: NOT regexp_matches(x, '^±[0-9]+(\\.[0-9]+)?$'))) = 0 AS valid, array_to_string(list_transform(range(1, 5), lambda i: t[i] || ' ' || v[i]), ';') AS lines, true AS clean FROM c"""


def compact_text(spark, d):
    return V.table(spark, d, "documents").select("doc_id", F.sha2(T.compact(F.col("text")), 256).alias("digest"))


def canonical_hash(spark, d):
    c = V.table(spark, d, "customer")
    j = T.canonical_json(key=F.col("c_custkey"), name=F.col("c_name"), segment=F.col("c_mktsegment"))
    return c.select("c_custkey", T.digest(j).alias("sha256"))


CANON_SQL = """SELECT c_custkey, sha256('{"key":' || c_custkey || ',"name":"' || c_name || '","segment":"' || c_mktsegment || '"}') AS sha256 FROM customer"""


def canonical_nested(spark, d):
    c = V.table(spark, d, "customer").selectExpr(
        "c_custkey", """concat('{ "z": [ {"k": ', c_custkey, ', "b": null, "a": "', c_name, '"}, 3, 1 ], "m" : {"y":true,"x":{"q":"ü \\\\"q\\\\"","p":[]}}, "a":', CAST(c_nationkey AS STRING), CASE WHEN c_custkey % 9 = 0 THEN '' ELSE '}' END) AS t"""
    )
    return c.select("c_custkey", T.digest(T.canonical_text(F.col("t"))).alias("sha256"))


NESTED_SQL = """SELECT c_custkey, CASE WHEN c_custkey % 9 > 0 THEN sha256('{"a":' || c_nationkey || ',"m":{"x":{"p":[],"q":"ü \\"q\\""},"y":true},"z":[{"a":"' || c_name || '","b":null,"k":' || c_custkey || '},3,1]}') END AS sha256 FROM customer"""


def switches(spark, d):
    e = V.table(spark, d, "orders").selectExpr("o_orderkey", "CASE o_orderkey % 5 WHEN 0 THEN concat('n=', CAST(o_orderkey AS STRING)) WHEN 1 THEN 'x=-1.5' WHEN 2 THEN 'f=True' WHEN 3 THEN 'j=[1,2]' ELSE concat('s=', o_orderpriority) END AS t")
    s = T.switch(F.col("t"))
    return e.select("o_orderkey", s["key"].alias("k"), s["kind"].alias("kind"), s["value"].alias("v"))


SWITCH_SQL = "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'n' WHEN 1 THEN 'x' WHEN 2 THEN 'f' WHEN 3 THEN 'j' ELSE 's' END AS k, CASE o_orderkey % 5 WHEN 0 THEN 'int' WHEN 1 THEN 'float' WHEN 2 THEN 'bool' WHEN 3 THEN 'json' ELSE 'str' END AS kind, CASE o_orderkey % 5 WHEN 0 THEN o_orderkey::VARCHAR WHEN 1 THEN '-1.5' WHEN 2 THEN 'True' WHEN 3 THEN '[1,2]' ELSE o_orderpriority END AS v FROM orders"


# -- bags -----------------------------------------------------------------------------------------------------------
def text_deficit(spark, d):
    return bags.deficit(V.words(spark, d), V.words(spark, d, "benchmark"), ["word"])


DEFICIT_SQL = with_views("word bword", ", n AS (SELECT word, count(*) AS n FROM word GROUP BY word), h AS (SELECT word, count(*) AS h FROM bword GROUP BY word) SELECT word, n - coalesce(h, 0) AS missing FROM n LEFT JOIN h USING (word) WHERE n > coalesce(h, 0)")


def bag_equal(spark, d):
    w = V.words(spark, d)
    return bags.bag_equal(w.filter("id % 2 = 0"), w.filter("id % 2 = 1"), ["word"])


BAG_SQL = with_views("word", ", d AS (SELECT word, sum(CASE WHEN id % 2 = 0 THEN 1 ELSE -1 END) AS d FROM word GROUP BY word) SELECT sum(greatest(d, 0))::BIGINT AS only_a, sum(greatest(-d, 0))::BIGINT AS only_b, sum(abs(d)) = 0 AS equal FROM d")


def vocab_guard(spark, d):
    vocab = V.words(spark, d, "benchmark").select("word").distinct()
    out = V.words(spark, d).filter(~F.col("word").rlike("^[0-9A-Z]$")).join(vocab, "word", "left_anti")
    return out.groupBy("id").agg(F.count(F.lit(1)).alias("unknown"), F.count_distinct("word").alias("kinds"))


VOCAB_SQL = with_views("word bword", " SELECT id, count(*) AS unknown, count(DISTINCT word) AS kinds FROM word WHERE NOT regexp_matches(word, '^[0-9A-Z]$') AND word NOT IN (SELECT word FROM bword) GROUP BY id")


def unique_first_order(spark, d):
    return bags.first_order_within(V.document_words(spark, d), ["id"], "words", "word")


UNIQUE_SQL = with_views("word", ", f AS (SELECT id, word, min(pos) AS first_pos FROM word GROUP BY ALL) SELECT *, row_number() OVER (PARTITION BY id ORDER BY first_pos)::INTEGER AS rank FROM f")


def mode_first(spark, d):
    return bags.mode_first_within(V.document_words(spark, d), ["id"], "words", "word")


MODE_SQL = with_views("word", ", f AS (SELECT id, word, count(*) AS n, min(pos) AS p FROM word GROUP BY ALL) SELECT id, word, n FROM f QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, p) = 1")


def duplicate_keys(spark, d):
    return bags.duplicates(V.words(spark, d), ["id", "word"])


DUP_SQL = with_views("word", " SELECT id, word, count(*) AS n FROM word GROUP BY ALL HAVING count(*) > 1")


def regress_diff(spark, d):
    o = V.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    now = o.filter("o_orderkey % 10 <> 3").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    return bags.compare_runs(o.filter("o_orderkey % 10 <> 4"), now, ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])


REGRESS_SQL = """WITH a AS (SELECT o_orderkey, o_orderstatus s FROM orders WHERE o_orderkey % 10 <> 4), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END s FROM orders WHERE o_orderkey % 10 <> 3)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'MISSING' WHEN a.o_orderkey IS NULL THEN 'NEW' WHEN a.s = b.s THEN 'SAME' ELSE 'DIFF' END AS verdict FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey"""


def index_quantile(spark, d):
    return bags.index_quantile(V.segments(spark, d).withColumn("len", F.col("hi") - F.col("lo")), ["page_id"], "len", 0.9)


QUANT_SQL = with_views("seg", ", r AS (SELECT page_id, hi - lo AS len, count(*) OVER (PARTITION BY page_id) AS n, row_number() OVER (PARTITION BY page_id ORDER BY hi - lo) - 1 AS r FROM seg) SELECT page_id, len FROM r WHERE r = least(CAST(floor(n * 0.9) AS BIGINT), n - 1)")


def order_inversions(spark, d):
    return bags.inversions(V.boxes(spark, d).withColumn("page_id", F.expr("box_id div 40")), ["page_id"], "x0", "y0")


INV_SQL = with_views("box", ", b AS (SELECT * REPLACE (box_id // 40 AS page_id) FROM box) SELECT a.page_id, count(*) FILTER (b.x0 > a.x0 AND b.y0 < a.y0) AS inversions FROM b a JOIN b ON a.page_id = b.page_id GROUP BY a.page_id")


def split_lines(spark, d):
    # only words of a group count, and a document's lines and groups are made distinct within its row
    grouped = F.transform(F.filter("words", lambda x: x["pos"] % 5 == 0), lambda x: F.struct(F.floor(x["pos"] / 12).alias("word"), (x["pos"] % 3).alias("pos")))
    w = V.document_words(spark, d, by_word=False).select("id", F.array_sort(grouped).alias("g"))
    w = w.select("id", F.filter("g", lambda x, i: (i == 0) | (x != F.get("g", i - 1))).alias("g"))
    t = w.select("id", F.explode(bags.tallied(F.col("g"))).alias("t"))
    return t.select("id", F.col("t.word").alias("line"), F.col("t.n").alias("groups")).filter("groups > 1")


SPLIT_SQL = with_views("word", " SELECT id, CAST(floor(pos / 12) AS BIGINT) AS line, count(DISTINCT CASE WHEN pos % 5 = 0 THEN pos % 3 END) AS groups FROM word GROUP BY ALL HAVING count(DISTINCT CASE WHEN pos % 5 = 0 THEN pos % 3 END) > 1")


def exact_row(spark, d):
    c = V.table(spark, d, "customer").select("c_custkey")
    o = V.table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return bags.exactly_one(c, o, "c_custkey")


EXACT_SQL = "SELECT c_custkey, count(o_custkey) AS matches, count(o_custkey) = 1 AS ok FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey"


def violations(spark, d):
    b = V.table(spark, d, "lineitem")
    rules = {"quantity": F.col("l_quantity") < 49, "discount": F.col("l_discount") <= 0.09, "flag": F.col("l_returnflag") != "R"}
    return bags.violations(b, ["l_orderkey", "l_linenumber"], rules).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


VIOL_SQL = "SELECT rule, count(*) AS n FROM (SELECT unnest([CASE WHEN NOT l_quantity < 49 THEN 'quantity' END, CASE WHEN NOT l_discount <= 0.09::DOUBLE THEN 'discount' END, CASE WHEN l_returnflag = 'R' THEN 'flag' END]) AS rule FROM lineitem) WHERE rule IS NOT NULL GROUP BY rule"


def visual_rows(spark, d):
    w = V.words(spark, d).selectExpr("id", "word", "CAST(pos % 10 AS DOUBLE) AS x", "CAST(floor(pos / 10) * 3 AS DOUBLE) + (pos % 3) * 0.9 AS y")
    return intervals.visual_rows(w, ["id"], "y", "x", "word", 2.0)


def last_wins(spark, d):
    t = V.table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return bags.last_wins(t, "conv_id", "turn").select("conv_id", "turn", "role")


LAST_SQL = "SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1"


def rotation_pick(spark, d):
    t = V.words(spark, d).selectExpr("id AS page_id", "CAST((pos % 4) * 90 AS INT) AS rot", "CASE WHEN (pos + length(word)) % 3 = 0 THEN 'up' ELSE 'right' END AS direction", "word AS text", "CAST(500 + (id % 5) * 80 AS INT) AS width", "600 AS height")
    return frames.rotation(t, ["page_id"])


ROT_SQL = with_views("word", """, t AS (SELECT id AS page_id, (pos % 4) * 90 AS rot, CASE WHEN (pos + length(word)) % 3 = 0 THEN 'up' ELSE 'right' END AS dir, length(trim(word)) AS n, 500 + (id % 5) * 80 AS w FROM word),
g AS (SELECT page_id, rot, dir, sum(n) AS n, max(w) AS w FROM t GROUP BY ALL), b AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY page_id, rot ORDER BY n DESC, dir DESC) = 1)
SELECT page_id, CAST(min(rot) AS INTEGER) AS rot FROM b WHERE dir = 'right' AND w > 600 GROUP BY page_id""")


def drawing_pages(spark, d):
    s = V.segments(spark, d)
    n = s.groupBy("page_id").agg(F.count(F.lit(1)).alias("paths")).filter("paths >= 300")
    return n.join(frames.detect(V.page_segments(spark, d), ["page_id"], 0.5, 0.3).filter("found >= 1").select("page_id"), "page_id", "left_semi")


def outlier_filter(spark, d):
    s = V.segments(spark, d).selectExpr("page_id", "seg_id", "CASE WHEN seg_id % 1000 = 1 THEN 1e6 ELSE lo END AS x", "hi - lo AS size")
    return frames.without_outliers(s, ["page_id"], "x", "size", 2.0).groupBy("page_id").agg(F.count(F.lit(1)).alias("kept"))


OUT_SQL = with_views("seg", ", s AS (SELECT page_id, CASE WHEN seg_id % 1000 = 1 THEN 1e6 ELSE lo END AS x, hi - lo AS size FROM seg), m AS (SELECT page_id, quantile_cont(x, 0.5) AS m, quantile_cont(size, 0.98) AS z FROM s GROUP BY page_id) SELECT page_id, count(*) AS kept FROM s JOIN m USING (page_id) WHERE abs(x - m) <= 2 * z GROUP BY page_id")


def kind_classify(spark, d):
    w = V.document_words(spark, d, by_word=False).select(
        "id", F.array_join(F.transform("words", lambda x: x["word"]), " ").alias("text"), F.size(F.filter("words", lambda x: F.rlike(x["word"], F.lit("^[0-9]{6,}$")))).cast("long").alias("parts"), F.size("words").cast("long").alias("shapes")
    )
    words = lambda *xs: F.array(*[F.lit(x) for x in xs])
    return w.select("id", blocks.kind(F.col("text"), F.col("parts"), F.col("shapes") % 20, words("token =", "License"), words("stupid", "idiot"), words("And ", "Der ")).alias("kind"))


KIND_SQL = with_views("word", """, w AS (SELECT id, string_agg(word, ' ' ORDER BY pos) AS t, count(*) FILTER (regexp_matches(word, '^[0-9]{6,}$')) AS p, count(*) % 20 AS s FROM word GROUP BY id)
SELECT id, CASE WHEN contains(t, 'token =') OR contains(t, 'License') OR p >= 2 THEN 'table' WHEN contains(t, 'stupid') OR contains(t, 'idiot') THEN 'pcb' WHEN (contains(t, 'And ') OR contains(t, 'Der ')) AND s <= 12 THEN 'performance' ELSE 'view' END AS kind FROM w""")


def body_colour(spark, d):
    c = _colours(spark, d).withColumns({"page_id": F.col("p_partkey") % 9, "colour": F.col("p_partkey") % 17, "is_neutral": C.is_neutral(F.col("r"), F.col("g"), F.col("b"))})
    return blocks.body_colour(c, ["page_id"], "colour", "p_partkey").withColumn("neutral_share", F.bround("neutral_share", 6))


# -- ledgers and sinks ----------------------------------------------------------------------------------------------
def attempt_ledger(spark, d):
    return ledger.attempts(V.job_events(spark, d), "job", ["ts", "event_id"])


LEDGER_SQL = with_views(
    "ev",
    """, e AS (SELECT *, sum((kind = 'reset')::INTEGER) OVER (PARTITION BY job ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS epoch FROM ev),
w AS (SELECT *, coalesce(sum((kind = 'run')::INTEGER) OVER (PARTITION BY job, epoch ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ran,
  coalesce(max((kind = 'success')::INTEGER) OVER (PARTITION BY job, epoch, recipe ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS won,
  lag(kind) OVER (PARTITION BY job, epoch ORDER BY ts, event_id) AS lk, lag(recipe) OVER (PARTITION BY job, epoch ORDER BY ts, event_id) AS lr FROM e)
SELECT job, ts, event_id, recipe, epoch::BIGINT AS epoch, (ran + 1)::BIGINT AS attempt, CASE WHEN won = 1 THEN 'REUSED' WHEN lk = 'fail' AND lr = recipe THEN 'UNCHANGED_FAILURE' WHEN ran >= 2 THEN 'RETRY_LIMIT' ELSE 'RUN' END AS decision FROM w WHERE kind = 'run'""",
)


def latest_state(spark, d):
    return ledger.latest(V.job_events(spark, d), "job", ["ts", "event_id"])


LATEST_SQL = with_views("ev", " SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY job ORDER BY ts DESC, event_id DESC) = 1")


def status_counts(spark, d):
    return V.job_events(spark, d).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("job").alias("jobs"))


STATUS_SQL = with_views("ev", " SELECT kind, count(*) AS n, count(DISTINCT job) AS jobs FROM ev GROUP BY kind")


def _plan(spark, d):
    plan = V.table(spark, d, "conversations").selectExpr("conv_id * 100 + turn AS item", "conv_id * 2 AS doc_id", "concat('src', CAST(turn % 9 AS STRING)) AS source_key", "CASE WHEN turn % 8 = 7 THEN NULL ELSE concat('f', CAST(turn % 3 AS STRING)) END AS file")
    rec = V.table(spark, d, "documents").selectExpr("doc_id", "array(source, concat(source, 'b')) AS sources", "CASE WHEN doc_id % 3 = 0 THEN array('f1') ELSE NULL END AS present")
    return plan, rec


def sink_plan(spark, d):
    plan, rec = _plan(spark, d)
    return ledger.attachment_plan(plan, rec, "doc_id", "source_key", "file")


SINK_SQL = """WITH p AS (SELECT conv_id * 100 + turn AS item, conv_id * 2 AS doc_id, 'src' || (turn % 9) AS source_key, CASE WHEN turn % 8 = 7 THEN NULL ELSE 'f' || (turn % 3) END AS file FROM conversations)
SELECT p.*, CASE WHEN d.doc_id IS NULL OR file IS NULL THEN 'SKIP_MISSING' WHEN NOT contains(source, source_key) THEN 'SKIP_MISMATCH' WHEN p.doc_id % 3 = 0 AND file = 'f1' THEN 'ALREADY' ELSE 'UPLOAD' END AS status FROM p LEFT JOIN documents d USING (doc_id)"""


def note_plan(spark, d):
    notes = V.table(spark, d, "labels").selectExpr("doc_id", "concat('quality ', CAST(quality AS STRING)) AS note")
    rec = V.table(spark, d, "documents").selectExpr("doc_id", "CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '[auto] old' WHEN 2 THEN ' ' ELSE source END AS remark")
    return ledger.note_plan(notes, rec, "doc_id", "note", "remark", "[auto] ")


NOTE_SQL = """WITH r AS (SELECT doc_id, coalesce(CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '[auto] old' WHEN 2 THEN ' ' ELSE source END, '') AS old FROM documents)
SELECT doc_id, old, CASE WHEN trim(old) <> '' THEN old || chr(10) ELSE '' END || '[auto] quality ' || quality AS new FROM labels JOIN r USING (doc_id) WHERE NOT contains(old, '[auto] ')"""


def note_check(spark, d):
    rec = V.table(spark, d, "documents").selectExpr("doc_id", "lang", "source AS remark")
    planned = rec.filter("doc_id % 5 = 0").select("doc_id", F.concat("remark", F.lit("!")).alias("new"))
    after = rec.withColumns({"remark": F.when(F.col("doc_id") % 10 == 0, F.concat("remark", F.lit("!"))).otherwise(F.col("remark")), "lang": F.when(F.col("doc_id") % 40 == 0, F.lit("xx")).otherwise(F.col("lang"))})
    return ledger.note_check(rec, after, planned, "doc_id", "remark")


NOTECHK_SQL = "SELECT doc_id FROM documents WHERE doc_id % 5 = 0 AND (doc_id % 10 <> 0 OR doc_id % 40 = 0)"


def survey_resume(spark, d):
    return ledger.pending(V.table(spark, d, "documents").select("doc_id", "source"), V.table(spark, d, "labels"), "doc_id")


RESUME_SQL = "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"


def finish_stage(spark, d):
    jobs = V.table(spark, d, "documents").select("doc_id")
    read = V.table(spark, d, "labels").selectExpr("doc_id", "CASE WHEN quality = 1 THEN 'READ' ELSE 'TO_READ' END AS status")
    gate = V.table(spark, d, "labels").selectExpr("doc_id", "toxic = 0 AS passed")
    return ledger.finish(jobs, read, gate, "doc_id")


FINISH_SQL = "SELECT doc_id, CASE WHEN coalesce(quality, 0) <> 1 THEN 'WAIT' WHEN toxic = 0 THEN 'FINAL_OK' ELSE 'FINAL_FAIL' END AS stage FROM documents LEFT JOIN labels USING (doc_id)"


def release_gate(spark, d):
    b = V.table(spark, d, "orders").selectExpr("o_orderkey", "o_orderstatus <> 'P' AS verified", "sha2(CAST(o_custkey AS STRING), 256) AS inventory_sha256", "sha2(CAST(o_orderkey AS STRING), 256) AS output_sha256")
    r = V.table(spark, d, "orders").filter("o_orderkey % 3 <> 0").selectExpr("o_orderkey", "sha2(CAST(o_custkey + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS STRING), 256) AS inventory_sha256", "sha2(CAST(o_orderkey AS STRING), 256) AS output_sha256", "CASE WHEN o_orderkey % 7 = 0 THEN 'FAIL' ELSE 'PASS' END AS verdict")
    return ledger.release(b, r, "o_orderkey").select("o_orderkey", "ready")


RELEASE_SQL = "SELECT o_orderkey, o_orderstatus <> 'P' AND o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AS ready FROM orders"


def template_upsert(spark, d):
    old = V.table(spark, d, "nation").select("n_nationkey", "n_name")
    new = V.table(spark, d, "nation").selectExpr("CAST(n_nationkey * 2 AS INT) AS n_nationkey", "lower(n_name) AS n_name").filter("n_nationkey % 3 = 0")
    return upsert(old, new, "n_nationkey")


UPSERT_SQL = "WITH n AS (SELECT (n_nationkey * 2)::INTEGER AS n_nationkey, lower(n_name) AS n_name FROM nation WHERE (n_nationkey * 2) % 3 = 0) SELECT n_nationkey, n_name FROM nation WHERE n_nationkey NOT IN (SELECT n_nationkey FROM n) UNION ALL SELECT * FROM n"


def field_packet(spark, d):
    f = V.table(spark, d, "documents").selectExpr("doc_id", "CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE source END AS model", "lang AS unit")
    return packet(f, ["model", "unit"])


PACKET_SQL = "SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR source IS NULL THEN 'READ_ME:model' ELSE source END AS model, coalesce(lang, 'READ_ME:unit') AS unit FROM documents"


# -- choices --------------------------------------------------------------------------------------------------------
def triage(spark, d):
    j = V.table(spark, d, "orders").selectExpr("o_orderkey", "o_orderstatus = 'P' AS failed", "array(CASE WHEN o_orderkey % 3 = 0 THEN 'LINE_SPLIT:1' END, CASE WHEN o_orderkey % 4 = 0 THEN 'INFO' END, CASE WHEN o_orderkey % 9 = 0 THEN 'FRAGMENTED_CLIP' END) AS flags")
    j = j.withColumn("flags", F.array_compact("flags"))
    return layout.triage(j, "flags", F.col("failed"), ["LINE_SPLIT", "FRAGMENTED_CLIP"]).select("o_orderkey", "triage", F.array_join("review_flags", ",").alias("review"))


TRIAGE_SQL = "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'EXCEPTION' WHEN o_orderkey % 3 = 0 OR o_orderkey % 9 = 0 THEN 'REVIEW' ELSE 'AUTO_OK' END AS triage, array_to_string(list_filter([CASE WHEN o_orderkey % 9 = 0 THEN 'FRAGMENTED_CLIP' END, CASE WHEN o_orderkey % 3 = 0 THEN 'LINE_SPLIT:1' END], lambda x: x IS NOT NULL), ',') AS review FROM orders"


def variant_pick(spark, d):
    p = V.table(spark, d, "part").selectExpr("p_partkey", "CAST(p_retailprice AS DOUBLE) AS plain", "p_retailprice * (85 + p_partkey % 20) / 100 AS house", "p_partkey % 2 = 0 AS auto")
    return layout.pick_variant(p, ["p_partkey"], "plain", "house", 0.97, "auto", 0.90).select("p_partkey", "choice")


VARIANT_SQL = "SELECT p_partkey, CASE WHEN p_retailprice * (85 + p_partkey % 20) / 100 >= CASE WHEN p_partkey % 2 = 0 THEN 0.9::DOUBLE ELSE 0.97::DOUBLE END * p_retailprice THEN 'variant' ELSE 'plain' END AS choice FROM part"


def font_ladder(spark, d):
    p = V.table(spark, d, "part").selectExpr("p_partkey", "length(p_name) AS len", "CAST(p_size * 4 AS DOUBLE) AS width")
    return layout.ladder(p, ["p_partkey"], "len", "width", [8.0, 7.0, 6.0, 5.0, 4.75])


LADDER_SQL = "SELECT p_partkey, list_filter([8.0, 7.0, 6.0, 5.0, 4.75]::DOUBLE[], lambda s: length(p_name) * 0.5 * s <= p_size * 4)[1] AS size FROM part"


def first_feasible(spark, d):
    s = V.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    return layout.first_feasible(s, ["l_orderkey"], F.col("l_quantity") >= 30, "l_linenumber", ["file", "at"])  # equal numbers: the first row of the table


FEASIBLE_SQL = "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 30 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) = 1"


def round_robin_columns(spark, d):
    s = V.table(spark, d, "nation").select("n_regionkey", "n_nationkey")
    return layout.columns(s, ["n_regionkey"], "n_nationkey", 3)


ROBIN_SQL = 'SELECT n_regionkey, n_nationkey, ((row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1) % 3)::INTEGER AS "column", ((row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1) // 3)::INTEGER AS line FROM nation'


def top_groups(spark, d):
    return V.segments(spark, d).groupBy("page_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "page_id").limit(50)


TOP_SQL = with_views("seg", " SELECT page_id, count(*) AS n FROM seg GROUP BY page_id ORDER BY n DESC, page_id LIMIT 50")

QUERIES = {
    "colour_class": (colour_class, COLOUR_SQL), "hex_recolour": (hex_recolour, HEX_SQL), "brand_model": (brand_model, BRAND_SQL), "field_split": (field_split, FIELD_SQL), "tolerance_check": (tolerance_check, TOL_SQL),
    "compact_text": (compact_text, None), "canonical_hash": (canonical_hash, CANON_SQL), "switches": (switches, SWITCH_SQL), "canonical_nested": (canonical_nested, NESTED_SQL), "text_deficit": (text_deficit, DEFICIT_SQL), "bag_equal": (bag_equal, BAG_SQL),
    "vocab_guard": (vocab_guard, VOCAB_SQL), "unique_first_order": (unique_first_order, UNIQUE_SQL), "mode_first": (mode_first, MODE_SQL), "duplicate_keys": (duplicate_keys, DUP_SQL), "regress_diff": (regress_diff, REGRESS_SQL),
    "index_quantile": (index_quantile, QUANT_SQL), "order_inversions": (order_inversions, INV_SQL), "split_lines": (split_lines, SPLIT_SQL), "exact_row": (exact_row, EXACT_SQL), "violations": (violations, VIOL_SQL),
    "visual_rows": (visual_rows, None), "last_wins": (last_wins, LAST_SQL), "rotation_pick": (rotation_pick, ROT_SQL), "drawing_pages": (drawing_pages, None), "outlier_filter": (outlier_filter, OUT_SQL),
    "kind_classify": (kind_classify, KIND_SQL), "body_colour": (body_colour, None), "attempt_ledger": (attempt_ledger, LEDGER_SQL), "latest_state": (latest_state, LATEST_SQL), "status_counts": (status_counts, STATUS_SQL),
    "sink_plan": (sink_plan, SINK_SQL), "note_plan": (note_plan, NOTE_SQL), "note_check": (note_check, NOTECHK_SQL), "survey_resume": (survey_resume, RESUME_SQL), "finish_stage": (finish_stage, FINISH_SQL),
    "release_gate": (release_gate, RELEASE_SQL), "template_upsert": (template_upsert, UPSERT_SQL), "field_packet": (field_packet, PACKET_SQL), "triage": (triage, TRIAGE_SQL), "variant_pick": (variant_pick, VARIANT_SQL),
    "font_ladder": (font_ladder, LADDER_SQL), "first_feasible": (first_feasible, FEASIBLE_SQL), "round_robin_columns": (round_robin_columns, ROBIN_SQL), "top_groups": (top_groups, TOP_SQL),
}
