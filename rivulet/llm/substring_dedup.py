"""Op 9: substring dedup with a count-min prefilter and an exact second pass.

A window is ``size`` consecutive words of one text. A word goes when it lies in a window whose word sequence also
starts in a document with a smaller key.

1. Sketch. Each task counts its windows' cells in a count-min sketch of ``ROWS`` rows; only whether a cell was met
   once or twice and more matters, so a cell is two bits. The sketches merge in a tree of bounded fan-in. Every
   window that occurs twice has all its cells met twice: the sketch overestimates and loses none.
2. Exact pass. Only windows estimated repeated are emitted, under 128 bits of two independent hashes, with the keys
   of the documents of one Arrow batch that hold them already put together. The smallest key of each window follows
   from a window function; documents beyond it get the window marked.
3. Marked windows meet their document's text, and the words under them go.

The sketch grows with the input up to ``2**MAX_BITS`` cells a row (a fixed 2**(MAX_BITS-2) bytes broadcast); beyond
that it passes more windows to the exact pass, which stays right. A window that a third of all documents hold gives
one row per Arrow batch, not one per document.

Defined results. Null text: no words, kept text empty. Texts under ``size`` words keep all. Documents with equal keys
do not remove from one another. Whole texts are read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm import textnum
from rivulet.llm.common import small_batches, stored, table, tidy

ROWS = 2
MAX_BITS = 28
BLOCK_BITS = 22
_A, _B = textnum.Poly(101), textnum.Poly(202)
#: Windows a task holds before it folds them into its sketch, and sketches that merge at once.
PENDING, FAN_IN = 1 << 21, 64


def _windows(words: textnum.Words, size: int, poly: textnum.Poly, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, text = words.runs(size) if at is None else (at, at)
    return starts, text, poly.spans(words.hashes(poly), starts, starts + size)


def _cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (textnum.mix(h ^ np.uint64(row + 1)) >> np.uint64(64 - bits)).astype(np.uint32)


def _twice(cells: np.ndarray, flags: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells in order, and whether each was met twice."""
    if flags is None:
        cells = np.sort(cells)
    else:
        order = np.argsort(cells, kind="stable")
        cells, flags = cells[order], flags[order]
    new = np.ones(len(cells), bool)
    new[1:] = cells[1:] != cells[:-1]
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(cells))) > 1
    if flags is not None and len(first):
        many |= np.bitwise_or.reduceat(flags.astype(np.uint8), first).astype(bool)
    return cells[first], many


def _encode(cells: np.ndarray, many: np.ndarray) -> bytes:
    """Cells of one block: gaps (32 bits, most of them small) and flags, deflated."""
    gaps = np.diff(cells, prepend=cells[:1] * 0).astype("<u4")
    wide = np.flatnonzero(gaps >= 255)
    small = np.minimum(gaps, 255).astype(np.uint8)
    head = np.array([len(cells), len(wide)], "<u4").tobytes()
    return head + zlib.compress(small.tobytes() + gaps[wide].tobytes() + np.packbits(many).tobytes(), 1)


def _decode(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, wide = np.frombuffer(blob[:8], "<u4")
    raw = np.frombuffer(zlib.decompress(blob[8:]), np.uint8)
    gaps = raw[:n].astype("<u4")
    gaps[gaps == 255] = raw[n : n + 4 * wide].view("<u4") if wide else 0
    return np.cumsum(gaps, dtype=np.uint32), np.unpackbits(raw[n + 4 * wide :], count=int(n)).astype(bool)


def sketch(docs: DataFrame, text: str, size: int, bits: int) -> list[tuple[int, int, bytes]]:
    """(row, block, bitmap of the cells met twice): at most ``ROWS * 2**bits / 8`` bytes in all."""
    block_bits = min(bits, BLOCK_BITS)
    low = np.uint32((1 << block_bits) - 1)

    def blocks(group, row, cells, many):
        at = cells >> np.uint32(block_bits)
        edges = np.searchsorted(at, np.arange((1 << (bits - block_bits)) + 1))
        for b in np.unique(at):
            part = slice(edges[b], edges[b + 1])
            yield group, row, int(b), _encode(cells[part] & low, many[part])

    def count(batches):
        group = TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        n = 0

        def flush():
            h = np.concatenate(held) if held else np.zeros(0, np.uint64)
            rows = [r for row in range(ROWS) for r in blocks(group, row, *_twice(_cells(h, row, bits)))]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.binary())],
                ["group", "row", "block", "blob"],
            )

        for batch in batches:
            for _, words in textnum.slices(batch.column(0)):
                h = _windows(words, size, _A)[2]
                held.append(h)
                n += len(h)
                if n >= PENDING:
                    yield flush()
                    n = 0
        if n:
            yield flush()

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [_decode(b) for b in pdf["blob"]]
        cells, many = _twice(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        return pd.DataFrame({"group": [pdf["group"].iloc[0]], "row": pdf["row"].iloc[:1].to_numpy(), "block": pdf["block"].iloc[:1].to_numpy(), "blob": [_encode(cells, many)]})

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        cells, many = _decode(pdf["blob"].iloc[0])
        bitmap = np.zeros(1 << block_bits, bool)
        bitmap[cells[many]] = True
        return pd.DataFrame({"row": pdf["row"].iloc[:1].to_numpy(), "block": pdf["block"].iloc[:1].to_numpy(), "bitmap": [np.packbits(bitmap, bitorder="little").tobytes()]})

    level = docs.select(F.col(text)).mapInArrow(count, "group long, row int, block int, blob binary")
    tasks = docs.rdd.getNumPartitions()
    width = 1  # tasks whose sketches have met
    while width < tasks:
        width *= FAN_IN
        level = level.withColumn("group", F.floor(F.col("group") / FAN_IN)).groupBy("group", "row", "block").applyInPandas(merge, "group long, row int, block int, blob binary")
    if tasks <= 1:  # several flushes of one task
        level = level.groupBy("group", "row", "block").applyInPandas(merge, "group long, row int, block int, blob binary")
    out = level.groupBy("row", "block").applyInPandas(final, "row int, block int, bitmap binary")
    return [(r["row"], r["block"], bytes(r["bitmap"])) for r in out.collect()]


def _bits_for(docs: DataFrame, text: str) -> int:
    """About four cells for each window, if that is within the limit."""
    n = docs.select(F.sum(F.octet_length(text))).first()[0] or 0
    return max(12, min(MAX_BITS, int(n // 3).bit_length()))


def repeated_windows(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 13, bits: int | None = None) -> DataFrame:
    """``key, windows``: hashes of the windows of each document that also start in one with a smaller key."""
    spark = docs.sparkSession
    small_batches(spark)
    tidy(spark)
    bits = bits or _bits_for(docs, text)
    filled = [np.zeros(max(1, (1 << bits) // 8), np.uint8) for _ in range(ROWS)]
    each = (1 << min(bits, BLOCK_BITS)) // 8
    for row, block, bitmap in sketch(docs, text, size, bits):
        filled[row][block * each : (block + 1) * each] = np.frombuffer(bitmap, np.uint8)
    shared = spark.sparkContext.broadcast(filled)  # its size is fixed by ``bits``

    def candidates(batches):
        maps = shared.value
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            held: list[tuple] = []
            for i, words in textnum.slices(batch.column(1)):
                at, doc, a = _windows(words, size, _A)
                ok = np.ones(len(a), bool)
                for row in range(ROWS):
                    c = _cells(a, row, bits)
                    ok &= (maps[row][c >> np.uint32(3)] >> (c & np.uint32(7)).astype(np.uint8) & 1).astype(bool)
                b = _windows(words, size, _B, at[ok])[2]
                held.append((a[ok], b, keys[doc[ok] + i]))
            a, b, k = (np.concatenate(x) for x in zip(*held)) if held else (np.zeros(0, np.uint64),) * 3
            order = np.lexsort((k, b, a))
            a, b, k = a[order], b[order], k[order]
            same = np.zeros(len(a), bool)  # as the row before
            same[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
            again = same.copy()
            again[1:] &= k[1:] == k[:-1]
            a, b, k, same = a[~again], b[~again], k[~again], same[~again]
            first = np.flatnonzero(~same)
            more = np.diff(np.append(first, len(a))) - 1
            rest = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(more)), pa.int32()), pa.array(k[same].astype(np.int64), pa.int64()), mask=pa.array(more == 0)
            ) if len(first) else pa.array([], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[first].view(np.int64)), pa.array(b[first].view(np.int64)), pa.array(k[first].astype(np.int64)), rest], ["a", "b", "k", "more"]
            )

    found = docs.filter(F.col(key).isNotNull()).select(F.col(key).cast("long"), F.col(text)).mapInArrow(candidates, "a long, b long, k long, more array<long>")
    least = found.withColumn("least", F.min("k").over(Window.partitionBy("a", "b")))
    later = F.filter(F.concat(F.array("k"), F.coalesce("more", F.array().cast("array<long>"))), lambda x: x > F.col("least"))
    hit = least.filter((F.col("k") > F.col("least")) | F.col("more").isNotNull()).select(F.explode(later).alias("key"), F.col("a"))
    return stored(hit.groupBy("key").agg(F.collect_list("a").alias("windows")), "hits")


def drop_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 13, bits: int | None = None) -> DataFrame:
    """``key, n_words, n_removed, kept``: each document's text without the words of windows met before.

    ``key``: an integer column. Kept words are joined by one blank.
    """
    hits = repeated_windows(docs, key=key, text=text, size=size, bits=bits)
    joined = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).join(hits, "key", "left")

    def cut(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            marked = batch.column(2)
            for i, words in textnum.slices(batch.column(1)):
                n = len(words.offsets) - 1
                here = marked.slice(i, n)
                gone = np.zeros(len(words) + 1, np.int64)
                if here.null_count < n:
                    at, doc, a = _windows(words, size, _A)
                    own = textnum.mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
                    lens = np.diff(here.offsets.to_numpy())
                    lens = np.where(here.is_null().to_numpy(zero_copy_only=False), 0, lens)
                    bad = here.flatten().to_numpy().view(np.uint64) ^ np.repeat(own, lens)
                    hit = at[np.isin(a ^ own[doc], bad)]
                    gone[hit] += 1
                    np.subtract.at(gone, hit + size, 1)
                keep = np.cumsum(gone)[:-1] == 0
                data = words.buf.tobytes()
                for t in range(n):
                    own_words = data[words.offsets[t] : words.offsets[t + 1]].split()
                    mask = keep[words.first[t] : words.first[t + 1]]
                    n_words.append(len(own_words))
                    n_removed.append(len(own_words) - int(mask.sum()))
                    kept.append(b" ".join(own_words if n_removed[-1] == 0 else compress(own_words, mask)).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], ["key", "n_words", "n_removed", "kept"]
            )

    return joined.mapInArrow(cut, "key long, n_words long, n_removed long, kept string")


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: every document's words, removed words, and the digest of what stays."""
    out = drop_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("key").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: DuckDB's form of the query.
SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
m AS (SELECT g, min(doc_id) AS least FROM s GROUP BY g HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT s.doc_id, s.i FROM s JOIN m USING (g) WHERE s.doc_id > m.least),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM hit, (SELECT unnest(range(13)) AS j)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY p) AS k, count(*) AS n
         FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY words.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
