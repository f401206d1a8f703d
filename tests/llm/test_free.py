"""Packing, neighbours, near-dedup, language ID, token counts, substring dedup."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from compare import same
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rivulet.llm import components, language_id, near_dedup, neighbours, packing, substring_dedup, token_count

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
STRANGE = ["", "a<|endoftext|>b<|startoftext|>", "x² ½ Ⅷ 12 _f_ it's we'LL they''s 'sound \"'s ΑΣ İ \n\n\t x\x1c\x1dy　z  é", "日本語 テキスト", "'", "''", "a'", "a" * 300, "é" * 200, "1'2's", " \x85 ", "<|endoftext|", "ß ẞ"]


def check_packing(out, texts):
    tok = Tokenizer.from_file(BYTE)
    for k, g in out.groupby("key", dropna=False):
        ids = tok.encode(texts.get(k) or "", add_special_tokens=False).ids + [2]
        g = g.sort_values("piece")
        assert list(g.piece) == list(range(len(g))) and g.length.sum() == len(ids) and (g.length.iloc[1:] == 1024).all()
        for r in g.itertuples():
            assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g.offset) == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 1024


def test_packing(docs):
    out = packing.packed(docs, BYTE).toPandas()
    check_packing(out, dict(docs.select("doc_id", "text").toPandas().itertuples(index=False)))
    assert out.sequence_id.nunique() <= -(-out.length.sum() // 1024) * 1.02 + 1


def test_packing_odd(odd, nothing):
    out = packing.packed(odd.filter("doc_id is not null"), BYTE).toPandas()
    check_packing(out, dict(odd.select("doc_id", "text").toPandas().itertuples(index=False)))
    assert packing.packed(odd.unionByName(odd), BYTE).count() > 2 * odd.count() - 1
    assert packing.packed(nothing, BYTE).count() == 0
    ids = packing.sequences(packing.packed(odd, BYTE, with_ids=True))
    assert ids.agg(F.max(F.size("ids"))).first()[0] <= 1024


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_valid_and_reduction_safe(seed):
    rng = np.random.default_rng(seed)
    counts = {int(s): int(n) for s, n in zip(rng.integers(1, 41, 12), rng.integers(1, 9, 12))}
    fixed, left = packing.reduce_dominated(dict(counts), 40)
    bins = [*fixed, *packing.best_fit(left, 40)]
    used = {}
    for pattern, n in bins:
        assert sum(pattern) <= 40
        for s in pattern:
            used[s] = used.get(s, 0) + n
    assert used == counts
    items = sorted((s for s, n in counts.items() for _ in range(n)), reverse=True)
    first_fit = []
    for s in items:
        b = next((i for i, r in enumerate(first_fit) if r >= s), None)
        if b is None:
            first_fit.append(40 - s)
        else:
            first_fit[b] -= s
    assert sum(n for _, n in bins) <= len(first_fit)


def test_tokens_equal_library():
    a, b, t = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD), packing.tokens(BYTE)
    for x in STRANGE:
        assert np.frombuffer(t.ids(x), "<u4").tolist() == a.encode(x, add_special_tokens=False).ids
    assert token_count.transducer(WORD).counts(STRANGE).tolist() == [len(b.encode(x, add_special_tokens=False).ids) for x in STRANGE]


def test_token_counts(docs, odd, nothing):
    lib = Tokenizer.from_file(WORD)
    out = token_count.token_counts(docs.select("doc_id", "text"), WORD).toPandas()
    assert out.n_tokens.tolist() == [len(e.ids) for e in lib.encode_batch(out.text.tolist(), add_special_tokens=False)]
    got = token_count.token_counts(odd, WORD).toPandas()
    assert got.n_tokens.tolist() == [len(lib.encode(x or "", add_special_tokens=False).ids) for x in got.text] and not got.over_limit.iloc[0]
    assert token_count.token_counts(nothing, WORD).count() == 0
    # words longer than a chunk, so that maps compose over several chunks
    words = ["ab" * 5000, "x" * 129 + " y " + "z" * 64, "-" * 200]
    assert token_count.transducer(WORD).counts(words).tolist() == [len(lib.encode(x, add_special_tokens=False).ids) for x in words]


def test_table_reset():
    t = token_count.Transducer(WORD)
    want = t.counts(STRANGE).tolist()
    t._reset()
    assert t.counts(STRANGE).tolist() == want


def test_substring_sql(spark, sf_dir, duck):
    same(substring_dedup.op9_substring_dedup(spark, sf_dir).toPandas(), duck.execute(substring_dedup.SQL).df())


def test_substring_small_sketch(docs):
    """A sketch that is far too small passes more windows on, and changes nothing."""
    a = substring_dedup.drop_repeats(docs, bits=12).toPandas().sort_values("key").reset_index(drop=True)
    b = substring_dedup.drop_repeats(docs).toPandas().sort_values("key").reset_index(drop=True)
    assert a.equals(b)


def test_substring_odd(odd, nothing):
    out = substring_dedup.drop_repeats(odd.unionByName(odd)).toPandas()
    assert len(out) == 2 * odd.count()
    r = out[out.key == 6].iloc[0]
    assert r.n_removed == 30 and r.kept == ""
    assert out[out.key == 5].n_removed.iloc[0] == 0 and out[out.key == 0].kept.iloc[0] == ""
    assert out[out.key == 9].kept.iloc[0] == "end"
    assert substring_dedup.drop_repeats(nothing).count() == 0


def test_language(docs, odd, nothing):
    train = docs.filter(~language_id.held_out(F.col("doc_id")))
    model = language_id.fitted(train)
    out = language_id.identify(docs, model).filter(language_id.held_out(F.col("doc_id"))).toPandas()
    assert (out.lang == out.lang_pred).mean() > 0.95 and out.score.between(0, 1).all() and out.accepted.mean() > 0.97
    got = language_id.identify(odd, model).toPandas()
    assert got.lang_pred.tolist()[:3] == ["und"] * 3 and not got.accepted[:3].any() and (got.score[:3] == 0).all()
    assert language_id.identify(nothing, model).count() == 0 and language_id.fitted(nothing) is None
    assert language_id.identify(odd, None).filter("lang_pred <> 'und'").count() == 0
    assert (language_id.fitted(train).table == model.table).all()


def shingle_set(t):
    w = (t or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_dedup(spark, docs):
    c = dict(near_dedup.near_classes(docs).toPandas().itertuples(index=False))
    rows = docs.select("doc_id", "text").toPandas()
    s = {k: shingle_set(t) for k, t in rows.itertuples(index=False)}
    ids = sorted(s)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            j = len(s[a] & s[b]) / max(1, len(s[a] | s[b]))
            if j >= 0.85:
                assert c[a] == c[b]
    groups = {}
    for k, v in c.items():
        groups.setdefault(v, []).append(k)
    for v, m in groups.items():
        assert v == min(m)
        for a in m:
            assert len(m) == 1 or max(len(s[a] & s[b]) / len(s[a] | s[b]) for b in m if b != a) >= 0.7
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_near_dedup_large_groups(spark):
    """A group of near copies and a passage many unlike documents share, both larger than any bucket bound."""
    w = lambda seed, n: " ".join(f"q{(seed * 7919 + k * 104729) % 99991}" for k in range(n))
    base = w(1, 200).split()
    rows = [(i, " ".join([*base[: i % 190], f"edit{i}", *base[i % 190 + 1 :]])) for i in range(150)]
    rows += [(1000 + i, w(5, 60) + " " + w(1000 + i, 140)) for i in range(150)]
    out = dict(near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).toPandas().itertuples(index=False))
    assert {out[i] for i in range(150)} == {0} and all(out[1000 + i] == 1000 + i for i in range(150))


def edited(base: list[str], name: str, edits: int) -> str:
    out = list(base)
    for e in range(edits):
        out[(int(name) * 6151 + e * 39119) % len(base)] = f"edit{name}x{e}"
    return " ".join(out)


def test_near_dedup_star(spark):
    """Thousands of copies, 0.8 to 0.9 like the original and less than 0.8 like each other, are one class."""
    base = [f"q{k * 7919}" for k in range(400)]
    texts = [" ".join(base), *[edited(base, str(i), 7 + i % 2) for i in range(1, 3001)]]
    s = [shingle_set(t) for t in texts]
    j = lambda a, b: len(s[a] & s[b]) / len(s[a] | s[b])
    assert all(0.8 < j(0, i) < 0.9 for i in range(1, 3001)) and sum(j(i, i + 1) < 0.8 for i in range(1, 3000)) > 2900
    rows = [((i * 1009) % 3001, t) for i, t in enumerate(texts)]
    out = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).toPandas()
    assert (out.class_id == 0).mean() > 0.998  # the bands' recall at 0.82


def test_near_links_of_one_large_bucket(spark):
    """The only meeting of 150 pairs alike in 52 of 64 samples is a bucket of 600 otherwise unlike members in three blocks."""
    rng = np.random.default_rng(3)
    sig = rng.integers(0, 1 << 16, (600, 64)).astype("<u2")
    sig[1:300:2, :52] = sig[0:300:2, :52]
    reps = spark.createDataFrame([(i, bytearray(x.tobytes()), [1]) for i, x in enumerate(sig)], "key long, sig binary, bh array<long>")
    one = lambda p: p.withColumn("similarity", F.lit(0.8))

    def blocks(members, sizes):
        rows = members.toPandas()
        assert sizes.first()["outside"] + sizes.first()["inside"] == len(rows) >= 290 and set(rows.key) <= set(range(300))
        return spark.createDataFrame([(i, i + 1, 0.8) for i in range(0, 300, 2)], near_dedup._LINK)

    links = near_dedup.near_links(reps, one, blocks, bands=16, rows=4, threshold=0.8)
    assert {(r.a, r.b) for r in links.collect()} == {(i, i + 1) for i in range(0, 300, 2)}


def test_common_weight():
    rng = np.random.default_rng(4)
    texts = [(rng.permutation(60)[:n].astype(np.uint64), np.zeros(n, np.float32), rng.integers(1, 4, n)) for n in (5, 40, 0, 60)]
    idf = rng.uniform(1, 9, 60).astype(np.float32)
    texts = [(s, idf[s.astype(int)], n) for s, _, n in texts]
    both, ta, tb = near_dedup.common_weight(texts, texts)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            x, y = (dict(zip(t[0].tolist(), (t[1].astype(float) * t[2]).tolist())) for t in (a, b))
            assert abs(both[i, j] - sum(min(x[s], y[s]) for s in x.keys() & y.keys())) < 1e-6
            assert abs(ta[i] - sum(x.values())) < 1e-6 and abs(tb[j] - sum(y.values())) < 1e-6
    assert components.spanning(np.array([1, 2, 1, 5]), np.array([2, 3, 3, 1])).tolist() == [0, 1, 3]


def test_near_dedup_links_at_the_threshold(spark):
    """Recall of pairs of 0.8 to 0.86 whose texts all share one passage, in a bucket of thousands; brute force decides."""
    rng = np.random.default_rng(8)
    head = [f"h{i}" for i in range(120)]
    texts = []
    for i in range(1200):
        body = [f"b{i}x{j}" for j in range(60)]
        other = list(body)
        for e in rng.choice(60, 2, replace=False):
            other[e] += "z"
        texts += [" ".join(head + body), " ".join(head + other)]
    s = [shingle_set(t) for t in texts]
    j = [len(s[2 * i] & s[2 * i + 1]) / len(s[2 * i] | s[2 * i + 1]) for i in range(1200)]
    assert min(j) > 0.85
    rows = [(i, t) for i, t in enumerate(texts)]
    out = dict(near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).toPandas().itertuples(index=False))
    found = sum(out[2 * i] == out[2 * i + 1] for i in range(1200))
    assert found >= 0.99 * 1200


def test_near_dedup_odd(odd, nothing):
    doubled = odd.unionByName(odd)
    c = dict(near_dedup.near_classes(doubled).toPandas().itertuples(index=False))
    assert c[5] == c[6] == 5 and c[8] == c[9] == 8 and all(c[i] == i for i in (0, 1, 2, 3, 4))
    assert near_dedup.near_classes(nothing).count() == 0 and near_dedup.keep_one(nothing).count() == 0
    assert near_dedup.keep_one(doubled).filter("doc_id = 5").count() == 1


def test_sampling_estimates_weighted_jaccard():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 2**63, 300).astype(np.uint64)
    wa, wb = rng.uniform(1, 9, 300).astype(np.float32), rng.uniform(1, 9, 300).astype(np.float32)
    s, w, t = np.concatenate([ids, ids[40:]]), np.concatenate([wa, wb[40:]]), np.repeat([0, 1], [300, 260])
    sig = near_dedup.samples(s, w, t, 2, 2000)
    o, p = np.argsort(ids), np.argsort(ids[40:])
    want = near_dedup.similarity((ids[o], wa[o]), (ids[40:][p], wb[40:][p]))
    assert abs((sig[0] == sig[1]).mean() - want) < 0.05


def test_components(spark, monkeypatch):
    e = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20] + [(20, 20)], "a long, b long")
    got = dict(components.components(e).toPandas().itertuples(index=False))
    assert all(got[i] == 0 for i in range(20)) and all(got[i] == 21 for i in range(21, 41)) and len(got) == 41
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 300, 250), rng.integers(0, 300, 250)
    monkeypatch.setattr(components, "FOREST", 40)
    rows = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)] * 3, "a long, b long")
    label = list(range(300))
    for _ in range(300):
        for x, y in zip(a, b):
            label[x] = label[y] = min(label[x], label[y])
    assert dict(components.components(rows).toPandas().itertuples(index=False)) == {int(v): label[v] for v in {*a, *b}}


def brute(x, ids, q, k):
    score = (x * x[q]).sum(axis=1)
    score[q] = -np.inf
    order = np.lexsort((ids, -score))[:k]
    return [(ids[o], score[o]) for o in order if np.isfinite(score[o])]


def test_neighbours(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    out = neighbours.nearest(e, F.col("vec_id") % 20 == 0, block_rows=200, chunk_rows=10).toPandas()
    d = e.toPandas()
    x, ids = np.stack(d.embedding).astype(float), d.vec_id.to_numpy()
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        want, got = brute(x, ids, q, 20), out[out.query_id == ids[q]].sort_values("rank")
        assert list(got["rank"]) == list(range(1, 21)) and (np.diff(got.score) <= 0).all()
        hit += len({i for i, _ in want} & set(got.vec_id))
        total += len(want)
    assert hit / total >= 0.95


def test_neighbours_odd(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [0.5, 2.0]), (8, [1.0, 1.0, 1.0]), (20, [1.0, 0.0]), (None, [1.0, 2.0]), (9, []), (10, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=3).toPandas()
    got = {k: list(g.sort_values("rank").vec_id) for k, g in out.groupby("query_id")}
    assert got == {0: [1, 2, 20], 20: [0, 1, 2]}
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    again = neighbours.nearest(df.unionByName(df), F.col("vec_id") % 20 == 0, k=3).toPandas()
    got = {k: list(g.sort_values(["rank", "vec_id"]).vec_id) for k, g in again.groupby("query_id")}
    assert got == {0: [0, 0, 1, 1, 1, 1], 20: [0, 0, 0, 0, 1, 1]}  # two rows of each query, each with its own three
