"""Drawing-like tables derived from the test tables with whole-number arithmetic, so every engine agrees.

They stand in for the geometry of vector drawings: they exercise the operators, not a real distribution. Each view
has a DataFrame form and the same as SQL (``SQL``), for the checks in another engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a task's share where a table is dealt to tasks by its count.
ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str, orders: int = 155) -> DataFrame:
    """Axis-parallel segments, those of ``orders`` orders a page: ``page_id, seg_id, orient, coord, lo, hi``."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"l_orderkey div {orders} AS page_id",
        "l_orderkey * 10 + l_linenumber AS seg_id",
        "CASE WHEN l_linestatus = 'O' THEN 'H' ELSE 'V' END AS orient",
        "CAST((7 * l_partkey) % 500 AS DOUBLE) + CAST(l_linenumber AS DOUBLE) / 10 AS coord",
        "CAST((13 * l_suppkey) % 800 AS DOUBLE) AS lo",
        "CAST((13 * l_suppkey) % 800 AS DOUBLE) + 5 + 4 * l_quantity AS hi",
    )


def page_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, orient, coord, lo, hi`` of ``segments``, a page in one task.

    Windows sort a task's share whole, so the number of tasks follows the table's count, not Spark's fixed number of
    shuffle partitions; groupings and joins by page that follow need no other shuffle. Small tables are left as they lie.
    """
    s = segments(spark, sf_dir).drop("seg_id")
    n = -(-table(spark, sf_dir, "lineitem").count() // ROWS)
    return s.repartition(n, "page_id") if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else s


_RULE = [
    "l_orderkey // 31 AS page_id",
    "((l_orderkey * 10 + l_linenumber) * 10000 + l_partkey) * 1000 + l_suppkey AS rule_id",
    "CASE WHEN l_linestatus = 'O' THEN 'H' ELSE 'V' END AS orient",
    "CAST(((7 * l_partkey) % CASE WHEN l_linestatus = 'O' THEN 59 ELSE 16 END) * CASE WHEN l_linestatus = 'O' THEN 10 ELSE 50 END AS DOUBLE) AS coord",
    "CAST(((13 * l_suppkey) % CASE WHEN l_linestatus = 'O' THEN 16 ELSE 6 END) * CASE WHEN l_linestatus = 'O' THEN 50 ELSE 100 END AS DOUBLE) AS lo",
    """CAST(least(CASE WHEN l_linestatus = 'O' THEN 800 ELSE 600 END, ((13 * l_suppkey) % CASE WHEN l_linestatus = 'O' THEN 16 ELSE 6 END) * CASE WHEN l_linestatus = 'O' THEN 50 ELSE 100 END
      + 50 * (1 + (l_partkey % 12))) AS DOUBLE) AS hi""",
]


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on a coarse raster of an 800 x 600 sheet, so that ends meet: ``page_id, rule_id, orient, coord, lo, hi``."""
    return table(spark, sf_dir, "lineitem").selectExpr(*[x.replace("//", "div") for x in _RULE])


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small boxes, 400 a page: ``page_id, box_id, x0, y0, x1, y1``."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey div 400 AS page_id",
        "p_partkey AS box_id",
        "CAST((37 * p_partkey + 11 * (p_partkey % 13)) % 800 AS DOUBLE) AS x0",
        "CAST((53 * p_partkey + 7 * (p_partkey % 17)) % 560 AS DOUBLE) AS y0",
        "CAST((37 * p_partkey + 11 * (p_partkey % 13)) % 800 + p_size % 12 AS DOUBLE) AS x1",
        "CAST((53 * p_partkey + 7 * (p_partkey % 17)) % 560 + p_partkey % 9 AS DOUBLE) AS y1",
    )


def furniture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large rectangles, 20 a page: ``page_id, furn_id, x0, y0, x1, y1``."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey div 20 AS page_id",
        "s_suppkey AS furn_id",
        "CAST((131 * s_suppkey) % 700 AS DOUBLE) AS x0",
        "CAST((97 * s_suppkey) % 480 AS DOUBLE) AS y0",
        "CAST((131 * s_suppkey) % 700 + 60 + (7 * s_suppkey) % 50 AS DOUBLE) AS x1",
        "CAST((97 * s_suppkey) % 480 + 30 + (11 * s_suppkey) % 40 AS DOUBLE) AS y1",
    )


_TILE = [
    "p_partkey // 40 AS page_id",
    "p_partkey AS tile_id",
    "CAST((37 * p_partkey) % 700 AS DOUBLE) AS x0",
    "CAST((53 * p_partkey) % 420 AS DOUBLE) AS y0",
    "CAST((37 * p_partkey) % 700 + 10 + 2 * (p_size % 30) AS DOUBLE) AS x1",
    "CAST((53 * p_partkey) % 420 + (p_partkey % 11) * 2 AS DOUBLE) AS y1",
]


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of 40 to a page, so that pages grow in number, not in density: ``page_id, tile_id, x0, y0, x1, y1``."""
    return table(spark, sf_dir, "part").selectExpr(*[x.replace("//", "div") for x in _TILE])


_SPAN = [
    "p_partkey // 120 AS page_id",
    "p_partkey AS span_id",
    "CAST((37 * p_partkey) % 500 AS DOUBLE) AS x0",
    "CAST(14 * ((53 * p_partkey) % 23) AS DOUBLE) + (p_partkey % 5) * 0.5 AS y0",
    "CAST((37 * p_partkey) % 500 + 3 + p_size AS DOUBLE) AS x1",
    "CAST(14 * ((53 * p_partkey) % 23) + 8 AS DOUBLE) + (p_partkey % 5) * 0.5 AS y1",
    "CAST(CASE ((53 * p_partkey) % 23) % 4 WHEN 0 THEN 24 WHEN 1 THEN 2 WHEN 2 THEN 8 ELSE 31 END AS DOUBLE) + (p_partkey % 3) * 0.25 AS size",
    "CASE WHEN p_partkey % 7 > 0 THEN p_partkey % 3 END AS grp",
]


def text_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of text in sizes that differ widely: ``page_id, span_id, x0, y0, x1, y1, size, grp`` (null: in no group)."""
    return table(spark, sf_dir, "part").selectExpr(*[x.replace("//", "div") for x in _SPAN])


def block_pieces(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Pieces of six blocks a page, some far from their block and some of no block: ``members``, ``furniture``, ``pages``."""
    far, at = "(p_partkey % 31 = 7)", "CASE WHEN p_partkey % 31 = 7 THEN (p_partkey + 1) % 6 ELSE p_partkey % 6 END"
    p = table(spark, sf_dir, "part").selectExpr(
        "p_partkey div 60 AS page_id", "p_partkey % 6 AS block", "p_partkey AS prim_id", "p_partkey % 10 = 3 AS rule", f"{far} AS far",
        f"CAST(({at}) % 3 * 180 + (37 * p_partkey) % 120 AS DOUBLE) AS x0", f"CAST(({at}) div 3 * 160 + (53 * p_partkey) % 110 AS DOUBLE) AS y0",
    )
    p = p.withColumns({"x1": F.expr("x0 + CASE WHEN rule THEN 70 ELSE 4 + prim_id % 9 END"), "y1": F.expr("y0 + CASE WHEN rule THEN 0.8D ELSE 3 + prim_id % 7 END")})
    own = F.col("prim_id") % 13 != 5
    pages_ = p.select("page_id").distinct().selectExpr("page_id", "0D AS x0", "0D AS y0", "560D AS x1", "330D AS y1", "6D AS i_x0", "6D AS i_y0", "540D AS i_x1", "320D AS i_y1")
    return {"members": p.filter(own).drop("far"), "furniture": p.filter(~own).drop("block", "far"), "pages": pages_}


def view_sheets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Up to seven views of one or two rectangles a page and a sheet for them: ``views``, ``sheets``."""
    p = table(spark, sf_dir, "part").selectExpr(
        "p_partkey div 7 AS page_id", "p_partkey AS view_id", "p_partkey % 7 = 6 AS rail", "CAST(7 AS DOUBLE) AS font", "CAST(p_partkey % 3 * 110 + (37 * p_partkey) % 25 AS DOUBLE) AS x",
        "CAST((p_partkey % 7) div 3 * 80 + (53 * p_partkey) % 17 AS DOUBLE) AS y", "30 + p_size AS w", "20 + (11 * p_partkey) % 45 AS h",
    )
    box = "named_struct('x0', {}, 'y0', {}, 'x1', {}, 'y1', {})"
    whole, upper, lower = box.format("x", "y", "x + w", "y + h"), box.format("x", "y", "x + w", "y + 9"), box.format("x", "y + 6", "x + 12", "y + h")
    views_ = p.selectExpr("page_id", "view_id", "rail", "font", f"inline(CASE WHEN view_id % 4 = 1 AND NOT rail THEN array({upper}, {lower}) ELSE array({whole}) END)")
    k = "(page_id % 5)"
    sheets_ = p.select("page_id").distinct().selectExpr(
        "page_id", "0D AS s_x0", "0D AS s_y0", "340D AS s_x1", "250D AS s_y1", "10D AS f_x0", "8D AS f_y0", f"CAST(250 + 25 * {k} AS DOUBLE) AS f_x1", f"CAST(150 + 20 * {k} AS DOUBLE) AS f_y1",
        f"array({box.format('CAST(150 + 25 * ' + k + ' AS DOUBLE)', 'CAST(120 + 20 * ' + k + ' AS DOUBLE)', 'CAST(250 + 25 * ' + k + ' AS DOUBLE)', 'CAST(150 + 20 * ' + k + ' AS DOUBLE)')}) AS reserved",
        "60D AS rail_width", "5.5D AS least_font",
    )
    return {"views": views_, "sheets": sheets_}


def list_sheets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Sheets with a list at the left of the title block, and often one beside it on shared rules, one page a customer.

    ``rules`` (page_id, orient, coord, lo, hi), ``words`` (page_id, pos, x0, y0, x1, y1, text), ``marks``, ``regions``
    (page_id, region_id, x0, y0, x1, y1) and ``frames``.
    """
    base = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS page_id", "c_custkey AS p", "4 + c_custkey % 6 AS n", "3 + c_custkey % 4 AS m", "575 - 15 * (4 + c_custkey % 6) AS top", "c_custkey % 5 = 0 AS both"
    )
    h = "named_struct('orient', 'H', 'coord', CAST({} AS DOUBLE), 'lo', CAST({} AS DOUBLE), 'hi', CAST({} AS DOUBLE))"
    v = h.replace("'H'", "'V'")
    frame = f"array({h.format(20, 20, 820)}, {h.format(575, 20, 820)}, {v.format(20, 20, 575)}, {v.format(820, 20, 575)})"
    left = f"transform(sequence(0, n), k -> {h.format('top + 15 * k', 20, 320)})"
    beside = f"transform(sequence(0, CASE WHEN both THEN n ELSE least(m, n) END), k -> {h.format('top + 15 * k', 'CASE WHEN k = 1 THEN 450 ELSE 320 END', 820)})"
    columns = f"transform(array(45, 200, 260, 320), x -> {v.format('x', 'top - CASE WHEN p % 7 = 3 THEN 15 ELSE 0 END', 575)})"
    others = f"transform(array(450, 600, 700), x -> {v.format('x', 'top', 'CASE WHEN both THEN 575 ELSE top + 15 * least(m, n) END')})"
    above = f"CASE WHEN p % 7 = 3 THEN array({h.format('top - 15', 20, 320)}) ELSE array() END"
    w = "named_struct('x0', CAST({0} AS DOUBLE), 'y0', CAST({1} + 3 AS DOUBLE), 'x1', CAST({0} + 12 AS DOUBLE), 'y1', CAST({1} + 11 AS DOUBLE), 'text', {2})"
    numbers = f"transform(sequence(0, n - 1), k -> {w.format(26, 'top + 15 * k', 'CASE WHEN p % 4 = 1 THEN concat(chr(97 + CAST(k AS INT)), chr(98)) ELSE CAST(n - k AS STRING) END')})"
    heads = f"CASE WHEN p % 2 = 0 THEN array({w.format(50, 'top + 15 * (n - 1)', chr(39) + 'QTY' + chr(39))}) ELSE array() END"
    title = f"array({w.format(330, 'top', chr(39) + 'REV' + chr(39))}, {w.format(460, 'top + 15', chr(39) + 'DATE' + chr(39))})"
    second = f"CASE WHEN p % 3 = 0 THEN array({w.format(610, 'top + 30', chr(39) + 'QTY' + chr(39))}) ELSE array() END"
    rules_ = base.selectExpr("page_id", f"inline(concat({frame}, {left}, {beside}, {columns}, {others}, {above}))")
    words_ = base.filter("p % 9 <> 4").selectExpr("page_id", f"posexplode(concat({numbers}, {heads}, {title}, {second})) AS (pos, w)").selectExpr("page_id", "CAST(pos AS BIGINT) AS pos", "w.*")
    marks_ = base.selectExpr("page_id", "explode(sequence(0, n - 1)) AS k", "top").selectExpr("page_id", "28D AS x0", "CAST(top + 15 * k + 5 AS DOUBLE) AS y0", "34D AS x1", "CAST(top + 15 * k + 9 AS DOUBLE) AS y1")
    regions_ = base.selectExpr("page_id", "0 AS region_id", "20D AS x0", "CAST(top + 15 * (p % 3) AS DOUBLE) AS y0", "820D AS x1", "575D AS y1")
    frames_ = base.selectExpr("page_id", "20D AS x0", "20D AS y0", "820D AS x1", "575D AS y1")
    return {"rules": rules_, "words": words_, "marks": marks_, "regions": regions_, "frames": frames_}


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8x8 bit grids: ``id, template, rotate, search, grid`` (array of 8 row masks)."""
    row = lambda r: " + ".join(f"CASE WHEN CAST(embedding[{8 * r + c}] AS DOUBLE) > 0.15 THEN {1 << c} ELSE 0 END" for c in range(8))
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id AS id",
        "concat('T', CAST(label AS STRING)) AS template",
        "CAST((vec_id % 4) * 90 AS INT) AS rotate",
        "CASE WHEN vec_id % 2 = 0 THEN 12 ELSE 30 END AS search",
        f"array({', '.join(f'CAST({row(r)} AS BIGINT)' for r in range(8))}) AS grid",
    )


def words(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """``id, pos, word``: blank-separated words, from 1."""
    key = {"documents": "doc_id", "benchmark": "item_id"}[name]
    return table(spark, sf_dir, name).select(F.col(key).alias("id"), F.posexplode(F.split("text", r"[ \n\t]+")).alias("pos", "word")).selectExpr(
        "id", "CAST(pos + 1 AS BIGINT) AS pos", "word"
    ).filter("word <> ''")


def document_words(spark: SparkSession, sf_dir: str, by_word: bool = True) -> DataFrame:
    """``id, words``: the words of ``words`` of each id, one row an id (array of ``word, pos``), ordered by both, or by position.

    Texts meet by id whole, so nothing is shuffled word by word. An id without words is left out.
    """
    one_text = lambda t: F.filter(F.transform(F.split(t, r"[ \n\t]+"), lambda w, i: F.struct(w.alias("word"), (i + 1).cast("long").alias("pos"))), lambda x: x["word"] != "")
    texts = table(spark, sf_dir, "documents").filter(F.col("text").rlike(r"[^ \n\t]")).groupBy(F.col("doc_id").alias("id")).agg(F.collect_list("text").alias("texts"))
    words_ = F.flatten(F.transform("texts", one_text))
    by_pos = F.transform(F.array_sort(F.transform(words_, lambda x: F.struct(x["pos"].alias("pos"), x["word"].alias("word")))), lambda x: F.struct(x["word"].alias("word"), x["pos"].alias("pos")))
    return texts.select("id", (F.array_sort(words_) if by_word else F.when(F.size("texts") > 1, by_pos).otherwise(words_)).alias("words"))


def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``job, event_id, ts, kind, recipe``: kinds run, success, fail, reset."""
    return table(spark, sf_dir, "events").selectExpr(
        "user_id AS job",
        "event_id",
        "ts",
        "CASE event_type WHEN 'error' THEN 'fail' WHEN 'purchase' THEN 'success' WHEN 'signup' THEN 'reset' ELSE 'run' END AS kind",
        "event_id % 3 AS recipe",
    )


def _fp_row(r: int) -> str:
    return " + ".join(f"CASE WHEN CAST(embedding[{8 * r + c + 1}] AS DOUBLE) > 0.15 THEN {1 << c} ELSE 0 END" for c in range(8))


SQL = {
    "seg": """SELECT l_orderkey // 155 AS page_id, l_orderkey * 10 + l_linenumber AS seg_id,
      CASE WHEN l_linestatus = 'O' THEN 'H' ELSE 'V' END AS orient,
      CAST((7 * l_partkey) % 500 AS DOUBLE) + CAST(l_linenumber AS DOUBLE) / 10 AS coord,
      CAST((13 * l_suppkey) % 800 AS DOUBLE) AS lo, CAST((13 * l_suppkey) % 800 AS DOUBLE) + 5 + 4 * l_quantity AS hi FROM lineitem""",
    "box": """SELECT p_partkey // 400 AS page_id, p_partkey AS box_id, CAST((37 * p_partkey + 11 * (p_partkey % 13)) % 800 AS DOUBLE) AS x0,
      CAST((53 * p_partkey + 7 * (p_partkey % 17)) % 560 AS DOUBLE) AS y0, CAST((37 * p_partkey + 11 * (p_partkey % 13)) % 800 + p_size % 12 AS DOUBLE) AS x1,
      CAST((53 * p_partkey + 7 * (p_partkey % 17)) % 560 + p_partkey % 9 AS DOUBLE) AS y1 FROM part""",
    "furn": """SELECT s_suppkey // 20 AS page_id, s_suppkey AS furn_id, CAST((131 * s_suppkey) % 700 AS DOUBLE) AS x0,
      CAST((97 * s_suppkey) % 480 AS DOUBLE) AS y0, CAST((131 * s_suppkey) % 700 + 60 + (7 * s_suppkey) % 50 AS DOUBLE) AS x1,
      CAST((97 * s_suppkey) % 480 + 30 + (11 * s_suppkey) % 40 AS DOUBLE) AS y1 FROM supplier""",
    "fp": f"""SELECT vec_id AS id, 'T' || CAST(label AS VARCHAR) AS template, CAST((vec_id % 4) * 90 AS INTEGER) AS rotate,
      CASE WHEN vec_id % 2 = 0 THEN 12 ELSE 30 END AS search, [{', '.join(f'CAST({_fp_row(r)} AS BIGINT)' for r in range(8))}] AS grid FROM embeddings""",
    "word": "SELECT id, pos, word FROM (SELECT doc_id AS id, unnest(range(1, len(ws) + 1)) AS pos, unnest(ws) AS word FROM (SELECT doc_id, regexp_split_to_array(text, '[ \\n\\t]+') AS ws FROM documents)) WHERE word <> ''",
    "bword": "SELECT id, pos, word FROM (SELECT item_id AS id, unnest(range(1, len(ws) + 1)) AS pos, unnest(ws) AS word FROM (SELECT item_id, regexp_split_to_array(text, '[ \\n\\t]+') AS ws FROM benchmark)) WHERE word <> ''",
    "ev": """SELECT user_id AS job, event_id, ts, CASE event_type WHEN 'error' THEN 'fail' WHEN 'purchase' THEN 'success'
      WHEN 'signup' THEN 'reset' ELSE 'run' END AS kind, event_id % 3 AS recipe FROM events""",
}


SQL["rule"] = "SELECT " + ", ".join(_RULE) + " FROM lineitem"
SQL["tile"] = "SELECT " + ", ".join(_TILE) + " FROM part"
SQL["span"] = "SELECT " + ", ".join(_SPAN) + " FROM part"
SQL["sheet"] = SQL["seg"].replace("// 155", "// 8")


def with_views(names: str, rest: str) -> str:
    """SQL with the named views in front; ``rest`` may go on with more of the WITH list (starting with a comma)."""
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names.split()) + "\n" + rest
