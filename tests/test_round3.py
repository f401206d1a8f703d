"""Small cases of the third round's findings: joins of exploded rows, open ties, folds that grew with their output."""

import pytest

from rivulet.plans import REGISTRY


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["line_neighbours", "torn_lines"])
def test_exploded_rows_are_not_broadcast(name, spark, sf_dir):
    assert "Broadcast" not in plan(REGISTRY[name][0](spark, sf_dir))


def test_blocks_of_fingerprints_give_what_all_pairs_give(spark, monkeypatch):
    import random

    from pyspark.sql import functions as F

    from rivulet.functions import bits
    from rivulet.operators import matching

    for name, size in (("PAGES", 7), ("SAMPLES", 11), ("ITEMS", 9)):
        monkeypatch.setattr(matching, name, size)
    r = random.Random(3)
    rows = [(i % 58, r.choice(["A", "B", None]), r.choice([0, 90]), r.choice([12, 12, 30]), [r.getrandbits(8) & r.getrandbits(8) for _ in range(8)]) for i in range(60)]
    rows.append((99, "A", 0, 77, [1] * 8))
    items = spark.createDataFrame(rows, "id long, template string, rotate int, search int, grid array<long>")
    old = matching.scored(items, items).groupBy("id", "template", "rotate", "search").agg(F.max("score"))
    out = matching.best_scores(items, items)
    assert sorted(map(str, out.collect())) == sorted(str(x).replace("max(score)", "score") for x in old.collect())
    assert {x["id"]: x["status"] for x in matching.match_status(items, items).collect()}[99] == "NO_FRAME"
    p, pw, pd_ = matching._packed(items, 8, 8, "a_")
    q, qw, qd = matching._packed(items, 8, 8, "b_")
    cols = lambda ns: [F.col(c) for c in ns]
    want = p.join(q, F.expr("a_search = b_search AND a_id < b_id")).select("a_id", "b_id", bits.coverage(cols(pw), cols(pd_), cols(qw), cols(qd))).collect()
    assert sorted(map(tuple, matching.pair_similarity(items, 0.0).collect())) == sorted(map(tuple, want))
    # the pairs stay in their tasks: a page comes out once for each kind of sample
    assert out.count() < matching.scored(items, items).count()


def test_visual_rows_of_a_long_text_and_of_words_without_height(spark):
    from rivulet.operators import intervals

    df = spark.range(40_000).selectExpr("1 AS k", "CAST(floor(id / 10) * 3 AS DOUBLE) + (id % 3) * 0.9 AS y", "CAST(id % 10 AS DOUBLE) AS x", "CAST(id AS STRING) AS t")
    odd = spark.createDataFrame([(2, None, 1.0, "a"), (2, None, 2.0, "b"), (2, 0.0, 5.0, "d"), (2, 1.9, 4.0, "c"), (2, 2.0, 1.0, "e")], "k int, y double, x double, t string")
    out = intervals.visual_rows(df.unionByName(odd), ["k"], "y", "x", "t").collect()
    assert sorted((r["row"], r["line"]) for r in out if r["k"] == 2) == [(1, "a"), (2, "b"), (3, "c  d"), (4, "e")]
    assert [r["line"] for r in sorted(out, key=lambda r: r["row"]) if r["k"] == 1] == ["  ".join(str(10 * i + j) for j in range(10)) for i in range(4000)]


def test_first_feasible_takes_the_first_row_of_equal_ranks(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id % 2 AS l_orderkey", "1 AS l_linenumber", "CAST(30 + id AS DOUBLE) AS l_quantity")
    rows.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        out = REGISTRY["first_feasible"][0](spark, str(tmp_path))
        assert ["file", "at"] == [c for c in ("file", "at") if c not in out.columns]
        assert sorted(map(tuple, out.collect())) == [(0, 1, 30.0), (1, 1, 31.0)]
        assert "at#" in plan(out)  # the order of rows, not that of arrival
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_first_clear_sorts_no_candidates(spark, sf_dir):
    from rivulet.operators import sheets

    text = plan(REGISTRY["first_clear_place"][0](spark, sf_dir))
    top = text[: text.index("ShuffledHashJoin")]  # what candidates pass after they met the cells
    assert "SortMergeJoin" not in top and "Window" not in top and "Sort [" not in top
    cells = spark.createDataFrame([(1, 1, 0), (1, 0, 2), (2, 0, 0)], "page int, ix long, iy long")
    rows = [(p, i, x, y, x + 1, y + 1) for p in (1, 2, 3) for i, (x, y) in enumerate([(0, 0), (1, 1), (0, 1), (1, 2), (5, 5)])]
    got = sheets.first_clear(cells, spark.createDataFrame(rows, "page int, id int, ix0 long, iy0 long, ix1 long, iy1 long"), ["page"], "id")
    assert {r["page"]: r["id"] for r in got.collect()} == {1: 1, 2: 1, 3: 0}


@pytest.mark.parametrize("name", ["unique_first_order", "mode_first", "split_lines", "kind_classify"])
def test_words_meet_within_their_document(name, spark, sf_dir):
    text = plan(REGISTRY[name][0](spark, sf_dir))
    assert text.count("Exchange") == 1 and "Window" not in text  # texts by id, no words


def test_documents_of_one_id_are_one_bag(spark, tmp_path):
    from pyspark.sql import functions as F

    from rivulet.operators import bags
    from rivulet.sources import views as V

    rows = [(1, "b a  b\tc"), (1, "c x"), (2, None), (3, " \n"), (4, "")] + [(5, " ".join("vwxyz"[i * i % 5] for i in range(40)))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    w, d = V.words(spark, str(tmp_path)), V.document_words(spark, str(tmp_path))
    assert sorted(d.select("id", F.inline("words")).select("id", "pos", "word").collect()) == sorted(w.collect())
    assert sorted(bags.mode_first_within(d, ["id"], "words", "word").collect()) == sorted(bags.mode_first(w, ["id"], "word", "pos").collect())
    a, b = (sorted((r["id"], r["word"], r["first_pos"]) for r in x.collect()) for x in (bags.first_order_within(d, ["id"], "words", "word"), bags.first_order(w, ["id"], "word", "pos")))
    assert a == b


def test_drawing_items_meet_areas_without_cells(spark, sf_dir):
    for name in ("drawing_items", "dropped_paths"):
        assert "__cx" not in plan(REGISTRY[name][0](spark, sf_dir))
    assert "Union" not in plan(REGISTRY["frame_policies"][0](spark, sf_dir)).split("HashAggregate")[0]


def test_rule_runs_with_missing_ends_equal_their_sql(spark, sf_dir, tmp_path):
    import duckdb
    from compare import same

    con = duckdb.connect()
    con.execute(
        f"""create table lineitem as select * replace (CASE WHEN l_partkey % 7 = l_linenumber THEN NULL ELSE l_quantity END AS l_quantity, CASE WHEN l_orderkey % 11 = 3 THEN NULL ELSE l_suppkey END AS l_suppkey)
        from '{sf_dir}/lineitem.parquet'"""
    )
    con.execute(f"copy lineitem to '{tmp_path}/lineitem.parquet' (format parquet)")
    for name in ("rule_runs", "coverage_window"):
        build, sql = REGISTRY[name]
        same(build(spark, str(tmp_path)).toPandas(), con.execute(sql).df())
