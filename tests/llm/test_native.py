"""Line dedup, fingerprints, secrets, mixing: against SQL or brute force, and the defined results of odd inputs."""

import hashlib
import re

import pytest
from compare import same
from pyspark.sql import functions as F

from rivulet.llm import fingerprints, line_dedup, mixing, secrets


def test_line_dedup_sql(spark, sf_dir, duck):
    same(line_dedup.op1_line_dedup(spark, sf_dir).toPandas(), duck.execute(line_dedup.SQL).df())


def test_line_dedup_drops_and_keeps(spark, odd, nothing):
    rows = [(i, f"menu\nbody {i}\n menu ", "a") for i in range(20)] + [(100 + i, "rare\nx", None) for i in range(3)] + [(200, None, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r for r in line_dedup.drop_boilerplate(df, max_ratio=0.5, detail=True).collect()}
    assert out[3]["text"] == "body 3" and out[3]["n_dropped"] == 2 and out[3]["n_lines"] == 3
    assert out[101]["text"] == "rare\nx" and out[200]["text"] is None and out[200]["n_lines"] == 0
    got = line_dedup.drop_boilerplate(odd, detail=True)
    assert got.count() == odd.count() and set(odd.columns) < set(got.columns)
    assert line_dedup.drop_boilerplate(nothing).count() == 0


def brute_pieces(text):
    """Pieces by the rule, as (piece, occurrence), and the code points of each."""
    rest = [x[i : i + fingerprints.LONGEST] for x in re.split(fingerprints.CUT, text[fingerprints.HEAD :]) for i in range(0, len(x), fingerprints.LONGEST)]
    cut = [x for x in re.findall(fingerprints.WORDS, text[: fingerprints.HEAD]) + rest if x]
    assert "".join(cut) == text
    seen, out = {}, set()
    for x in cut:
        seen[x] = seen.get(x, 0) + 1
        out.add((x, seen[x]))
    return out


def likeness(a, b):
    size = lambda s: sum(len(x) for x, _ in s)
    return size(a & b) / size(a | b) if a | b else 1.0


def listed(print_):
    """Code points, cells of a subtable and the filled cells of a returned fingerprint."""
    n, size, cells = print_.split("|")
    rows = [c.split(".") for c in cells.split(",")] if cells else []
    return int(n), int(size), {int(c, 16): (int(k), int(x, 16), int(s, 16)) for c, k, x, s in rows}


def unpeeled(a, b):
    """Code points only in a and only in b, from two returned fingerprints with as many cells."""
    diff = {c: (p[0] - q[0], p[1] ^ q[1], p[2] ^ q[2]) for c in a.keys() | b.keys() for p, q in [(a.get(c, (0, 0, 0)), b.get(c, (0, 0, 0)))]}
    only = {1: set(), -1: set()}
    checks = {x: s for k, x, s in [*a.values(), *b.values()] if k == 1}
    while True:
        pure = {x: k for k, x, s in diff.values() if abs(k) == 1 and checks.get(x) == s}
        if not pure:
            break
        x, k = next(iter(pure.items()))
        only[k].add(x)
        for c in CELLS[x]:
            n, key, s = diff.get(c, (0, 0, 0))
            diff[c] = (n - k, key ^ x, s ^ checks[x])
    assert all(v == (0, 0, 0) for v in diff.values())
    return [sum(x & 511 for x in only[k]) for k in (1, -1)]


CELLS: dict = {}


def brute_check(out, texts, ids):
    prints = {}
    for i, (k, t) in enumerate(zip(ids, texts)):
        n = texts[(i + 1) % len(texts)]
        q = len(t) // 3
        e = t[: len(t) - q] + n[:q]
        r = out.loc[k]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint and prints.setdefault(e, r.edited_fingerprint) == r.edited_fingerprint
        a, b, c = brute_pieces(t), brute_pieces(e), brute_pieces(n)
        assert abs(r.near_edited - likeness(a, b)) < 1e-9 and abs(r.near_next - likeness(a, c)) < 1e-9
        n_chars, cells, filled = listed(r.fingerprint)
        assert n_chars == len(t) and sum(x[0] for x in filled.values()) == 3 * len(a) and max(filled, default=0) < 3 * cells


def test_fingerprints_brute(spark, sf_dir, docs):
    out = fingerprints.op4_fingerprints(spark, sf_dir).toPandas().set_index("doc_id")
    d = docs.select("doc_id", "text").toPandas().sort_values("doc_id", ascending=False)
    brute_check(out, d.text.tolist(), d.doc_id.tolist())
    assert set(out.index) == set(d.doc_id)
    long = out[out.n_chars > 30]
    assert long.near_edited.min() > 0.15 and long.near_edited.mean() > 0.45  # two thirds of every text stay


def test_fingerprints_without_stops(spark):
    """Long texts without any stop, a text of one word, short texts, one edit."""
    w = [f"w{i * 7919 % 5003}" for i in range(800)]
    texts = [" ".join(w), " ".join([*w[:400], "changed", *w[401:]]), "spam " * 3000, "one two three four five six seven eight", "one two three four six six seven eight", "x" * 5000, ""]
    df = spark.createDataFrame([(-i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = fingerprints.fingerprints(df).toPandas().set_index("key")
    brute_check(out, texts, [-i for i in range(len(texts))])
    assert out.near_next[0] > 0.95 and out.near_next[-3] > 0.6 and (out.near_edited > 0.3).all()


def test_returned_prints_are_compared(spark):
    """Subtracting and peeling the returned fingerprints gives the likeness that is returned."""
    base = [f"w{i}" for i in range(300)]
    df = spark.createDataFrame([(2, " ".join(base)), (1, " ".join([*base[:100], "other", *base[101:]]))], "doc_id long, text string")
    out = fingerprints.fingerprints(df).toPandas().set_index("key")
    (n, size, a), (m, other, b) = listed(out.fingerprint[2]), listed(out.fingerprint[1])
    assert size == other
    alone = spark.createDataFrame([(str(x),) for x in {x for s in (a, b) for k, x, _ in s.values() if k == 1}], "x string")
    alone = alone.select("x", F.conv("x", 10, -10).cast("long").alias("s"))
    places = [fingerprints._cell("s", F.lit(j), str(size.bit_length() - 1)).alias(f"c{j}") for j in range(3)]
    CELLS.update({int(r["x"]): {r["c0"], r["c1"], r["c2"]} for r in alone.select("x", *places).collect()})
    only_a, only_b = unpeeled(a, b)
    assert abs(out.near_next[2] - (n - only_a) / (n + only_b)) < 1e-9 and m > 0


def test_fingerprints_odd(odd, nothing):
    doubled = odd.unionByName(odd.filter("doc_id = 3"))
    out = fingerprints.fingerprints(doubled).toPandas()
    assert len(out) == doubled.count() and (out.key == 3).sum() == 2
    assert out[out.key == 1].fingerprint.iloc[0] == out[out.key == 0].fingerprint.iloc[0] == "0|1024|"
    assert fingerprints.fingerprints(nothing).count() == 0


def test_peeling_retries(spark):
    """Sketches of few cells often fail; retries, and in the end exact counts, give the same likeness."""
    rows = [(i, " ".join(f"{chr(97 + (i * k) % 23)}{k}" for k in range(6))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    a, b = (fingerprints.fingerprints(df, least=n).select("key", "near_edited", "near_next").toPandas().sort_values("key").reset_index(drop=True) for n in (8, 1024))
    assert a.equals(b)
    pieces = spark.createDataFrame([(0, 0, s, 2, 2, x * 512 + 7) for s in (0, 1) for x in range(40 * s, 100)], "k long, h long, side int, b0 int, b1 int, x long")
    failed = fingerprints.differing(pieces, ["k", "h"], 0).filter("pair = 1").first()
    assert failed["open"] > 0
    got = {r["pair"]: (r["only_a"], r["only_b"]) for r in fingerprints.exactly_differing(pieces, ["k", "h"]).collect()}
    assert got == {0: (280, 0), 1: (700, 0)}


def test_secrets(spark, odd, nothing):
    key = "87e15d78b9d8ef29b6c10061e3551a60fa07e990"
    rows = [(1, f'aa token = "{key}" bb', "src0"), (2, "card 4929963689861572 and 4929963689861572", "x"), (3, None, None), (4, f"see commit {key[::-1]} ok", "docs/a"), (5, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    model = secrets.trained(secrets.labelled_findings(spark))
    out = secrets.scan(df, model).toPandas()
    hit = out[out.key == 1].iloc[0]
    assert hit.candidate == key and rows[0][1][hit.start : hit.start + 40] == key and hit.is_secret
    cards = out[out.key == 2].sort_values("start")
    assert list(cards.start) == [5, 26] and not cards.is_secret.any()
    assert not out[out.key == 4].is_secret.any() and set(out.key) == {1, 2, 4}
    assert secrets.scan(odd, model).count() >= 0 and secrets.scan(nothing, model).count() == 0
    held = secrets.features(secrets.labelled_findings(spark, 2000, seed=9))
    p = model.transform(held).select("label", "prediction").toPandas()
    assert (p.label == p.prediction).mean() > 0.95


def test_mixing(spark, sf_dir, docs):
    out = mixing.op10_mix(spark, sf_dir).toPandas()
    again = mixing.op10_mix(spark, sf_dir).toPandas()
    assert out.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()
    d = docs.select("doc_id", "text", "source").toPandas()
    d["w"] = [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in d.text]
    out = out.merge(d)
    assert (out["size"] == out.w).all() and (out.taken <= 3 * out["size"]).all() and len(out) == len(d)
    g = out.groupby("source", dropna=False).agg(taken=("taken", "sum"), size=("w", "sum"), target=("target", "first"))
    assert abs(g.target.sum() - g["size"].sum()) < 1e-6
    big = out.groupby("source", dropna=False).w.max()
    assert ((g.taken - g.target).abs() <= big.reindex(g.index) + 0.1 * g.target).all()


def brute_targets(sizes, weights, most):
    left = dict(enumerate(weights))
    out, total = {}, sum(sizes)
    while left:
        level = (total - sum(out.values())) / sum(left.values())
        full = [i for i in left if level * left[i] > most * sizes[i]]
        if not full:
            return {**out, **{i: level * w for i, w in left.items()}}
        for i in full:
            out[i] = most * sizes[i]
            del left[i]
    return out


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 1000, 1000, 5, 0], [10], [1, 2, 3, 4, 500], [0, 0]])
def test_targets(spark, sizes):
    rows = [(f"s{i}", n) for i, n in enumerate(sizes)]
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    want = brute_targets(sizes, [(5.0, 2.0, 1.0)[i % 3] for i in range(len(sizes))], 3.0)
    assert all(abs(got[f"s{i}"] - want.get(i, 0.0)) < 1e-6 for i in range(len(sizes)))


def test_pivotal_keeps_sums(spark):
    units = spark.range(5000).select(F.lit("g").alias("g"), (F.col("id") % 3).cast("int").alias("cls"), F.col("id").alias("u"), F.lit(0).cast("long").alias("k"), F.lit(0.3).alias("p"))
    out = mixing.pivotal(units, bundle=16).toPandas()
    assert len(out) == 5000 and out.u.is_unique and set(out.up) == {0, 1} and abs(out.up.sum() - 1500) <= 1


def test_mixing_odd(odd, nothing):
    doubled = odd.unionByName(odd)
    out = mixing.mixed(doubled).toPandas()
    assert len(out) == doubled.count() and (out[out["size"] == 0].copies == 0).all()
    mix = mixing.mix(doubled)
    assert mix.columns == odd.columns and mix.count() == out.copies.sum()
    assert mixing.mixed(nothing).count() == 0 and mixing.mix(nothing).count() == 0
