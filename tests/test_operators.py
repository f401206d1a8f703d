"""Fixtures with known answers, and properties, for the operators."""

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.functions import bits
from rivulet.functions import colour as C
from rivulet.functions import geometry as G
from rivulet.functions import text as T
from rivulet.operators import bags, graph, intervals, ledger, matching, sheets
from rivulet.sources import files


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def lit_rect(*v):
    return G.rect(*[F.lit(float(x)) for x in v])


def test_subtract_keeps_area(spark):
    r = one(spark, G.subtract(lit_rect(0, 0, 12, 8), lit_rect(2, 1, 7, 5)).alias("p"))["p"]
    assert sum((p["x1"] - p["x0"]) * (p["y1"] - p["y0"]) for p in r) == 76
    assert len(r) == 4
    assert len(one(spark, G.subtract(lit_rect(0, 0, 1, 1), lit_rect(5, 5, 6, 6)).alias("p"))["p"]) == 1


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 20), st.integers(1, 9), st.integers(1, 9)), min_size=1, max_size=4))
def test_subtract_all_area(spark, cutters):
    cuts = F.array(*[lit_rect(x, y, x + w, y + h) for x, y, w, h in cutters])
    left = one(spark, G.subtract_all(F.array(lit_rect(0, 0, 25, 25)), cuts).alias("p"))["p"]
    cells = {(x, y) for x in range(25) for y in range(25)} - {(x + i, y + j) for x, y, w, h in cutters for i in range(w) for j in range(h)}
    assert sum((p["x1"] - p["x0"]) * (p["y1"] - p["y0"]) for p in left) == len(cells)


def test_snap_is_exact_in_single_precision(spark):
    for v in (7.3, 1041.017, 88.8881):
        x = one(spark, G.snap(F.lit(v)).alias("x"), G.snap(F.lit(v)).cast("float").cast("double").alias("y"))
        assert x["x"] == x["y"] and abs(x["x"] - v) <= 1 / 128


@pytest.mark.parametrize(
    "profile,colour,want",
    [
        ("legacy-v1", (1, 0, 0), "gold"), ("legacy-v1", (0, 0, 0), "blue"), ("cyan-gold-v1", (0, 1, 1), "gold"), ("cyan-gold-v1", (1, 0, 0), "blue"), ("cyan-gold-v1", (0, 0, 1), "blue"),
        ("cyan-gold-v1", (1, 1, 1), "same"), ("nonblack-gold-v1", (0.1, 0.12, 0.15), "blue"), ("nonblack-gold-v1", (0, 0, 1), "gold"), ("nonblack-gold-v1", (1, 1, 1), "same"),
    ],
)
def test_colour_profiles(spark, profile, colour, want):
    assert one(spark, C.classify(*[F.lit(float(c)) for c in colour], profile).alias("k"))["k"] == want


def test_unknown_profile():
    with pytest.raises(ValueError):
        C.classify(F.lit(0.0), F.lit(0.0), F.lit(0.0), "none")


def test_hex_text(spark):
    r = one(spark, C.recolour_hex(F.lit("a#ff0000b #00ffff"), "cyan-gold-v1", "#00f", "#fa0").alias("t"), C.recolour_hex(F.lit("x #00ffff;#fff"), "cyan-gold-v1", "#00f", "#fa0").alias("u"))
    assert r["u"] == "x #fa0;#fff"
    assert r["t"].endswith("#fa0")


@pytest.mark.parametrize(
    "model,want",
    [("QX-lamp 7", "lamp 7"), ("zr-Ω9", "Ω9"), ("Yy-yy-1", "yy-1"), ("QXlamp", "QXlamp"), ("AQX-3", "AQX-3"), ("ZR-", "ZR-")],
)
def test_prefixes(spark, model, want):
    assert one(spark, T.strip_prefix(F.lit(model), ["QX-", "ZR-", "YY-"]).alias("m"))["m"] == want


def test_compact_and_redecode(spark):
    df = spark.createDataFrame([("Ａ １\n b",), (None,), ("plain x",)], "t string")
    assert [r[0] for r in df.select(T.compact(F.col("t"))).collect()] == ["A1b", None, "plainx"]
    once = "图纸".encode("gbk").decode("latin-1")
    twice = "公差".encode("gbk").decode("latin-1").encode("utf-8").decode("cp1252")
    plus = b"\xa1\xe0".decode("latin-1") + "0.5"
    rows = [(once, "图纸"), (twice, "公差"), (plus, "±0.5"), ("ok", "ok"), ("×3 ±1°", "×3 ±1°"), (None, None), ("漢", "漢")]
    assert [tuple(r) for r in spark.createDataFrame(rows, "t string, w string").select(T.redecode("t"), "w").collect()] == [(w, w) for _, w in rows]


def test_near_tie_prefers_upright(spark):
    def pick(second):
        rows = [(4, "k", 180, 3, 0.8), (4, "k", 0, 3, second), (4, "m", 0, 3, 0.97)]
        out = matching.best_of_template(spark.createDataFrame(rows, "id int, template string, rotate int, search int, score double"))
        return out.filter("template = 'k'").first()["rotate"]

    assert pick(0.792) == 0 and pick(0.785) == 180


def greedy_stars(n, sims, weight, least):
    """One choice after another, by brute force."""
    near = {i: {j for j in range(n) if sims.get((min(i, j), max(i, j)), 0) >= least and j != i} for i in range(n)}
    free, out = set(range(n)), []
    while free:
        lead = min(free, key=lambda i: (-len(near[i] & free), -weight[i], i))
        out.append(sorted(near[lead] & free | {lead}))
        free -= set(out[-1])
    mean = lambda i, g: round(sum(1.0 if i == j else sims.get((min(i, j), max(i, j)), 0) for j in g) / len(g), 4)
    out.sort(key=len, reverse=True)  # keeps the order of choice
    return [(min(g, key=lambda i: (-mean(i, g), -weight[i], i)), g) for g in out]


@pytest.mark.parametrize("seed", range(3))
def test_star_clusters_like_one_choice_after_another(spark, seed):
    import random

    rng = random.Random(seed)
    n = 24
    sims = {(i, j): round(rng.random(), 3) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.4}
    weight = [float(rng.randrange(3)) for _ in range(n)]
    items = spark.createDataFrame(list(enumerate(weight)), "id long, weight double")
    got = matching.star_clusters(items, spark.createDataFrame([(*k, v) for k, v in sims.items()], "a long, b long, sim double"), 0.7)
    groups = {}
    for r in got.collect():
        groups.setdefault((r["group_no"], r["representative"]), []).append(r["id"])
    assert [(k[1], sorted(groups[k])) for k in sorted(groups)] == greedy_stars(n, sims, weight, 0.7)
    assert matching.star_clusters(items.limit(0), spark.createDataFrame([], "a long, b long, sim double"), 0.7).count() == 0


def test_pack_round_trip(spark):
    grid = [(i * 2654435761) % (1 << 40) for i in range(80)]
    df = spark.createDataFrame([(grid,)], "g array<bigint>")
    assert df.select(bits.unpack(bits.pack("g"))).first()[0] == grid


def test_dilation_wraps(spark):
    df = spark.createDataFrame([([1, 0, 0, 0],)], "g array<bigint>")
    assert df.select(bits.dilate(F.col("g"), 4)).first()[0] == [0b1011, 0b1011, 0, 0b1011]


@pytest.mark.parametrize(
    "values,want",
    [
        ([], []), ([3], []), ([3, 8], []), ([1, 5, 9], [(1, 9, 4, 3)]), ([0, 6, 12, 14, 18, 40], [(0, 18, 6, 5)]), ([0, 6, 12, 13, 14, 18], [(0, 12, 6, 3), (12, 14, 1, 3)]),
        ([0, 1, 50, 57, 64, 71, 90, 110, 130.5], [(50, 71, 7, 4), (71, 130.5, 19, 4)]), ([0, 100, 200, 211.9], [(0, 200, 100, 3)]),
    ],
)
def test_equal_pitch(spark, values, want):
    df = spark.createDataFrame([([float(v) for v in values],)], "v array<double>")
    assert [tuple(r) for r in df.select(intervals.equal_pitch(F.col("v")).alias("r")).first()["r"]] == want



@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(1, 20)), min_size=1, max_size=12))
def test_union_length(spark, spans):
    df = spark.createDataFrame([(1, float(a), float(a + n)) for a, n in spans], "k int, lo double, hi double")
    covered = len({x for a, n in spans for x in range(a, a + n)})
    assert intervals.union_length(df, ["k"]).first()["covered"] == covered
    assert intervals.runs(df, ["k"]).agg(F.sum(F.col("hi") - F.col("lo"))).first()[0] == covered


def test_visual_rows(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0, "b"), (1, 1.5, 0.0, "a"), (1, 3.0, 0.0, "c")], "k int, y double, x double, t string")
    out = {r["row"]: r["line"] for r in intervals.visual_rows(df, ["k"], "y", "x", "t").collect()}
    assert out == {1: "a  b", 2: "c"}


def test_components_long_chain(spark):
    n = 60
    e = spark.createDataFrame([(i, i + 1) for i in range(n) if i != 30], "a long, b long")
    v = spark.range(n + 2).withColumnRenamed("id", "v")
    got = {r["v"]: r["comp"] for r in graph.components(v, e).collect()}
    assert all(got[i] == 0 for i in range(31)) and all(got[i] == 31 for i in range(31, n + 1)) and got[n + 1] == n + 1


def test_merge_grows(spark):
    rows = [(1, 1, 0, 0, 10, 10), (1, 2, 5, 0, 15, 10), (1, 3, 11, 0, 21, 4), (1, 4, 50, 50, 60, 60)]
    df = spark.createDataFrame([(a, b, *map(float, r)) for a, b, *r in rows], "page_id long, id long, x0 double, y0 double, x1 double, y1 double")
    out = {r["block"]: r["n"] for r in graph.merge_overlapping(df, ["page_id"], "id").collect()}
    assert out == {1: 3, 4: 1}


def test_row_packing(spark):
    def corners(sizes, **kw):
        df = spark.createDataFrame([(sizes,)], "s array<struct<w:double,h:double>>")
        out = df.select(sheets.packed_rows(F.col("s"), F.lit(1.0), 100.0, 100.0, 10.0, **kw).alias("p")).first()["p"]
        return out and [(c["x"], c["y"]) for c in out]

    assert corners([(40.0, 10.0), (40.0, 20.0), (30.0, 5.0)]) == [(0, 0), (50, 0), (0, 30)]
    assert corners([(101.0, 1.0)]) is None
    assert corners([(40.0, 10.0), (40.0, 20.0), (30.0, 5.0)], corner=(60.0, 15.0)) == [(0, 0), (0, 20), (0, 50)]  # the taller one must end before the corner
    assert corners([(70.0, 20.0)], corner=(60.0, 15.0)) is None


def test_largest_scale(spark):
    rows = [(1, i, 0.0, 0.0, 10.0, 10.0) for i in range(4)]
    df = spark.createDataFrame(rows, "page_id long, id long, x0 double, y0 double, x1 double, y1 double")
    s = sheets.largest_scale(df, ["page_id"], "id", 100.0, 100.0, gap=0.0, most=30.0).first()["scale"]
    assert abs(s - 5.0) < 1e-6  # two rows of two


def test_label_fields(spark):
    w = spark.createDataFrame([(1, 1, 1.0, 1.0, 9.0, 3.0, "Model:"), (1, 2, 10.0, 1.0, 19.0, 3.0, "AB 1"), (1, 3, 30.0, 1.0, 39.0, 3.0, "other"), (1, 4, 1.0, 21.0, 9.0, 23.0, "Unit:")], "page_id long, word_id long, x0 double, y0 double, x1 double, y1 double, text string")
    lines = spark.createDataFrame([(1, "V", 25.0, 0.0, 50.0), (1, "H", 10.0, 0.0, 50.0)], "page_id long, orient string, coord double, lo double, hi double")
    labels = spark.createDataFrame([("model", "Model"), ("unit", "Unit")], "field string, label string")
    out = {r["field"]: (r["value"], r["flag"]) for r in sheets.label_fields(w, lines, labels, ["page_id"]).collect()}
    assert out == {"model": ("AB 1", None), "unit": (None, "VALUE_NOT_TEXT_NEEDS_READ")}


def test_bags(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "w string")
    b = spark.createDataFrame([("x",), (None,)], "w string")
    assert sorted((r["w"], r["missing"]) for r in bags.deficit(a.filter("w is not null"), b, ["w"]).collect()) == [("x", 1), ("y", 1)]
    r = bags.bag_equal(a, b, ["w"]).first()
    assert (r["only_a"], r["only_b"], r["equal"]) == (2, 0, False)
    empty = a.limit(0)
    assert bags.bag_equal(empty, empty, ["w"]).first()["equal"]


def test_attempts(spark):
    ev = [(1, 1, "run", 7), (1, 2, "fail", 7), (1, 3, "run", 7), (1, 4, "run", 8), (1, 5, "success", 8), (1, 6, "run", 8), (1, 7, "run", 9), (1, 8, "reset", 9), (1, 9, "run", 9)]
    df = spark.createDataFrame(ev, "job int, event_id int, kind string, recipe int")
    got = [r["decision"] for r in ledger.attempts(df, "job", ["event_id"]).orderBy("event_id").collect()]
    assert got == ["RUN", "UNCHANGED_FAILURE", "RETRY_LIMIT", "REUSED", "RETRY_LIMIT", "RUN"]


def test_files(spark, tmp_path):
    p = tmp_path / "n.ndjson"
    p.write_text('{"id":"a","v":1}\n\n{"id":"b","v":2}\n{"id":"a","v":3}\n')
    assert sorted(tuple(r) for r in files.read_ndjson_last(spark, str(p), "id string, v int", "id").collect()) == [("a", 3), ("b", 2)]
    (tmp_path / "d").mkdir()
    for n in ("x.pdf", "y.pdf"):
        (tmp_path / "d" / n).write_bytes(b"1")
    (tmp_path / "d" / "s").mkdir()
    (tmp_path / "d" / "s" / "x.pdf").write_bytes(b"2")
    assert sorted(r["name"] for r in files.list_files(spark, str(tmp_path / "d")).collect()) == ["x", "x_2", "y"]
    files.write_once(spark.range(1), str(tmp_path / "o"))
    with pytest.raises(Exception):
        files.write_once(spark.range(1), str(tmp_path / "o"))
    files.write_summary_csv(spark.createDataFrame([(1, "a,b")], "n int, t string"), str(tmp_path / "c"))
    text = next((tmp_path / "c").glob("part-*")).read_text(encoding="utf-8")
    assert text == '﻿n,t\n1,"a,b"\n'
    k = tmp_path / "k.json"
    k.write_text('{"a": 1, "zz": 2}')
    assert [r[0] for r in files.unknown_keys(spark, str(k), ["a"]).collect()] == ["zz"]


def test_streams(spark, sf_dir, tmp_path):
    from rivulet.sources import views
    from rivulet.streaming import attempt_stream, resume_into

    ev = views.job_events(spark, sf_dir).select("job", "event_id", "kind", "recipe")
    ev.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ev.schema).parquet(str(tmp_path / "in"))
    q = attempt_stream(stream).writeStream.format("memory").queryName("att").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("att").toPandas().sort_values("event_id").reset_index(drop=True)
    want = ledger.attempts(ev, "job", ["event_id"]).toPandas().sort_values("event_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got[["event_id", "attempt", "decision"]], want[["event_id", "attempt", "decision"]], check_dtype=False)
    for _ in range(2):
        resume_into(spark.readStream.schema(ev.schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), "event_id", str(tmp_path / f"cp{_}")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == ev.count()
