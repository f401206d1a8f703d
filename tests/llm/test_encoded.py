"""Vector codes, cross-tokenizer alignment and token files against plain loops and the libraries."""

import collections
import glob
import hashlib
import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from compare import same
from pyspark.sql import functions as F

from rivulet.llm import alignment, neighbours, queries, token_files, vector_codes

BYTES, PIECES, WORDS = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))


# -- vector codes ----------------------------------------------------------------------------------------------------


def _lloyd(rows, parts, entries, rounds):
    """rows: (id, label, whole numbers) in the order of the first codebook."""
    width = len(rows[0][2]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, _, v in rows[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v, p: min((far(cut(v, p), c), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = collections.defaultdict(list)
            for _, _, v in rows:
                own[nearest(v, p)[1]].append(cut(v, p))
            new.append([[sum(c) // len(own[e]) for c in zip(*own[e])] if own[e] else c for e, c in enumerate(books[p])])
        books = new
    return {i: ([nearest(v, p)[1] for p in range(parts)], sum(nearest(v, p)[0] for p in range(parts))) for i, _, v in rows}, books


@pytest.mark.parametrize("large", [1.0, 3e4, 3e6])
def test_vector_codes_equal_plain_lloyd(spark, large):
    rng = np.random.default_rng(4)
    vectors = [(int(i), int(i % 3) if i % 5 else None, [float(np.float32(x * large)) for x in rng.normal(size=8)]) for i in rng.permutation(60)]
    vectors += [(100 + i, 7, vectors[0][2]) for i in range(5)]  # equal vectors
    rows = sorted((i, label, [int(np.floor(x * 1024)) for x in v]) for i, label, v in vectors)
    df = spark.createDataFrame(vectors, "vec_id long, label int, embedding array<float>")
    out, books = vector_codes.product_codes(df.repartition(5), parts=2, entries=8, rounds=3)
    want, want_books = _lloyd(rows, 2, 8, 3)
    assert books.tolist() == want_books
    assert {r["id"]: (r["codes"], r["error"]) for r in out.collect()} == {i: (c, min(e, 2**63 - 1)) for i, (c, e) in want.items()}


def test_vector_codes_query(spark, duck, sf_dir):
    same(queries.queries()["op11_vector_codes"](spark, sf_dir).toPandas(), duck.execute(queries.oracle_sql()["op11_vector_codes"]).df())


def test_vector_codes_odd(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0], None), (2, None, 1), (3, [1.0, None, 3.0, 4.0], 1), (4, [1.0, float("nan"), 3.0, 4.0], 1), (5, [float("inf"), 1.0, 1.0, 1.0], 1), (6, [1.0, 2.0], 1), (7, [], 1), (None, [-0.5, 0.0, 1e30, -1e30], None), (1, [1.0, 2.0, 3.0, 4.0], None), (9, [1.0] * 8, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("error", F.lit("x")).withColumn("codes", F.lit(1))
    out, books = vector_codes.product_codes(df)
    got = out.collect()
    assert sorted((r["id"] is None, r["id"]) for r in got if r["id"]) == [(False, 1), (False, 1)] and len(got) == 3
    assert all(r["error"] == 0 for r in got) and books.shape == (4, 3, 1) and abs(books).max() == vector_codes.LARGEST
    none, _ = vector_codes.product_codes(df.limit(0))
    assert none.count() == 0 and none.columns == ["id", "label", "codes", "error"]


def test_only_changed_parts_are_sent(spark):
    """The second round's contributions come from the rows whose code has changed."""
    state = spark.createDataFrame([([1, 2], [0, 1], [0, 1]), ([5, 6], [0, 0], [1, 0]), ([7, 8], None, [1, 1])], "v array<long>, old array<int>, codes array<int>")
    got = {(r["part"], r["entry"]): (r["n"], r["sums"]) for r in vector_codes.moved(state, 2, 2, 1).collect()}
    assert got == {(0, 0): (-1, [-5]), (0, 1): (2, [12]), (1, 1): (1, [8])}


# -- alignment -------------------------------------------------------------------------------------------------------


def _aligned(rows):
    """Whole texts by the libraries; links by comparing every token with those around it."""
    both = alignment.Pair(BYTES, PIECES)
    per, counts = [], collections.Counter()
    for key, text in rows:
        links, groups, a, b = [], [], [], []
        if text:
            raw = (" " + text).encode()
            a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
            if b"".join(both.bytes_a[i] for i in a) != raw or b"".join(both.bytes_b[i] for i in b) != raw:
                a = b = []
        if a:
            end_a, end_b = np.cumsum([both.len_a[i] for i in a]), np.cumsum([both.len_b[i] for i in b])
            start_a, start_b = end_a - [both.len_a[i] for i in a], end_b - [both.len_b[i] for i in b]
            for i in range(len(a)):
                links += [(a[i], b[j]) for j in range(np.searchsorted(end_b, start_a[i], "right"), np.searchsorted(start_b, end_a[i], "left"))]
            i = j = 0
            for c in np.intersect1d(end_a, end_b):
                x, y = np.searchsorted(end_a, c) + 1, np.searchsorted(end_b, c) + 1
                groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
                i, j = x, y
        per.append((key, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
        counts.update(set(links))
    most = collections.defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    rows = [(key, na, nb, ng, len(ls), sum(counts[x] == most[x[0]] for x in ls), sum(counts[x] for x in ls), h) for key, na, nb, ng, ls, h in per]
    return sorted(rows, key=order), counts


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def test_alignment_query_equals_whole_texts(spark, docs, sf_dir):
    want, _ = _aligned([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert _got(queries.queries()["op12_alignment"](spark, sf_dir)) == want


def test_alignment_of_odd_strings(spark):
    import random

    rng = random.Random(2)
    signs = ["a", "B", "'s", " ", "\n", "\r", "\r\n", ";", "}", "\t", " ", "́", "é", "ς", " ", "\x1c", "\x85", "<|endoftext|>", "</s>", "<unk>", "漢", "½", "9", "İ", "한", "_", "-", "🙂", "‍", "  ", "'", "\x00", "　", "hello", "▁"]
    rows = [(k, "".join(rng.choices(signs[:-1] if k % 9 else signs, k=rng.randint(0, 14)))) for k in range(1500)]
    rows += [(1500, None), (None, "no key"), (1501, "x" * 20000), (1501, "same key"), (1502, " ".join(["hello world"] * 900)), (1503, "▁")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_a", F.lit("x")).withColumn("block", F.lit(1))
    out, pairs = alignment.aligned(df, BYTES, PIECES, block_bytes=4000)
    want, counts = _aligned(rows)
    assert _got(out) == want
    assert {(r["a"], r["b"]): r["n"] for r in pairs.collect()} == dict(counts)


def test_alignment_of_nothing(spark):
    out, pairs = alignment.aligned(spark.createDataFrame([], "doc_id long, text string"), BYTES, PIECES)
    assert out.count() == 0 and pairs.count() == 0
    out, _ = alignment.aligned(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), BYTES, PIECES)
    assert _got(out) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


# -- token files -----------------------------------------------------------------------------------------------------


def _ids(text):
    from tokenizers import Tokenizer

    _ids.tok = getattr(_ids, "tok", None) or Tokenizer.from_file(WORDS)
    return np.array(_ids.tok.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def test_token_files_query_equals_the_library(spark, docs, sf_dir):
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.queries()["op13_token_files"](spark, sf_dir).collect()}
    start, want = 0, {}
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        ids = _ids(r["text"])
        want[r["doc_id"]] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert got == want


def test_word_ids_equal_the_library():
    import random

    rng, coder = random.Random(1), token_files.WordIds(WORDS)
    assert coder.apart and coder.simple
    odd = ["a", "B", "'s", " ", "\n", "\t", " ", "́", "é", "é", "Σ", "ς", "\x1c", "\x85", "<|endoftext|>", "漢", "½", "9", "٣", "ͅ", "İ", "ﬁ", "한", "_", "🙂", "‍", "'LL", "Å", "\x00", "　", "﻿"]
    latin = [chr(c) for c in [*range(33, 127), *range(0xA1, 0x250)]] + [" "] * 20 + ["'s", "'Re"]
    for k in range(6000):
        text = "".join(rng.choices(odd if k % 2 else latin, k=rng.randint(0, 12)))
        assert next(coder.many([text])) == _ids(text)[:-1].astype("<u2").tobytes(), repr(text)
    for c in range(33, 0x250):
        for text in (chr(c), f"a{chr(c)}b", chr(c) * 3 + "."):
            assert next(coder.many([text])) == _ids(text)[:-1].astype("<u2").tobytes(), repr(text)


def test_token_files_odd(spark, odd, nothing, tmp_path):
    token_files.write(odd, f"{tmp_path}/odd", WORDS, ranges=3, frame_bytes=64, file_bytes=200)
    index = token_files.read_index(spark, f"{tmp_path}/odd")
    got = token_files.with_starts(index).orderBy("start").collect()
    rows = sorted(odd.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    assert [(r["key"], r["n"], r["ids_crc32"]) for r in got] == [(r["doc_id"], len(i := _ids(r["text"])), zlib.crc32(i.tobytes())) for r in rows]
    assert [r["start"] for r in got] == [sum(r["n"] for r in got[:i]) for i in range(len(got))]
    assert len(glob.glob(f"{tmp_path}/odd/part-*")) > 3
    wanted = spark.createDataFrame([(8,), (10,), (99,)], "key long")
    back = {r["key"]: r["ids"] for r in token_files.read_documents(spark, f"{tmp_path}/odd", wanted, index).collect()}
    assert back == {r["doc_id"]: _ids(r["text"]).tolist() for r in rows if r["doc_id"] in (8, 10)}
    token_files.write(nothing, f"{tmp_path}/none", WORDS, ranges=3)
    assert token_files.with_starts(token_files.read_index(spark, f"{tmp_path}/none")).count() == 0


def test_hot_key_is_spread_over_its_ranges(spark, tmp_path):
    rows = [(5 if i % 2 else i, f"text {i}") for i in range(400)]
    token_files.write(spark.createDataFrame(rows, "doc_id long, text string"), f"{tmp_path}/hot", WORDS, ranges=8)
    index = token_files.read_index(spark, f"{tmp_path}/hot")
    per = {r["range"]: r["count"] for r in index.groupBy("range").count().collect()}
    assert len(per) >= 6 and max(per.values()) < 120 and sum(per.values()) == 400
    keys = [r["key"] for r in token_files.with_starts(index).orderBy("start").collect()]
    assert keys == sorted(keys)


def test_reader_decompresses_only_what_is_asked_for():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 49408, n).astype("<u2") for n in [5, 0, 300, 40000, 7, 12, 90, 3]]
    build = token_files.FileBuilder(2, (3, 7), frame_bytes=256)
    for i, t in enumerate(texts):
        build.add(i, t.tobytes())
    content = build.finish()
    assert content[-4:] == token_files.SEEKABLE
    file = token_files.opened(io.BytesIO(content))
    assert file.number == [3, 7] and file.keys == list(range(8))
    assert file.ids(6).tolist() == texts[6].tolist() and file.decompressed == 1
    assert [file.ids(i).tolist() for i in range(8)] == [t.tolist() for t in texts]
    import zstandard

    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content), read_across_frames=True).read()
    assert whole == b"".join(t.tobytes() for t in texts)  # any reader of the format gives the ids
    bad = bytearray(content)
    bad[len(bad) // 2] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.opened(io.BytesIO(bytes(bad))).ids(3)


# -- neighbours: ties ------------------------------------------------------------------------------------------------


def test_neighbours_of_many_ties(spark):
    rng = np.random.default_rng(6)
    rows = [(0, [1.0, 0.0, 0.0, 0.0])] + [(int(i), [0.5, *(float(v) for v in rng.integers(-8, 9, 3) / 8)]) for i in rng.permutation(np.arange(1, 400))]
    out = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 0, confidence=1.0)
    assert [(r["rank"], r["vec_id"], r["score"]) for r in out.orderBy("rank").collect()] == [(i, i, 0.5) for i in range(1, 21)]


def test_neighbours_of_rows_that_share_an_id(spark):
    rows = [(0, [1.0, 0.0]), (0, [2.0, 0.0]), (3, [0.5, 0.0]), (3, [0.5, 0.0]), (3, [3.0, 1.0])]
    out = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=4)
    got = sorted((r["rank"], r["vec_id"], r["score"]) for r in out.collect())
    assert got == sorted([(1, 3, 3.0), (2, 0, 2.0), (3, 3, 0.5), (4, 3, 0.5), (1, 3, 6.0), (2, 0, 2.0), (3, 3, 1.0), (4, 3, 1.0)])
