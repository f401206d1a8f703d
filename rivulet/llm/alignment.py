"""Op 12: the tokens of two tokenizers aligned, each distinct segment of the corpus once.

Every text (with a space before it) is cut into segments before white-space runs. Both vocabularies are looked through
first: a byte-level file cuts there by its own pattern; in a piece model no piece may hold a character that is no white
space with this white space behind it, or else runs that begin so do not cut. So no token crosses a border, and what a
tokenizer makes of a segment does not depend on its neighbours. A segment is encoded behind a guard character that no
piece holds, which keeps the model's own leading space off it.

Plan. Texts are read in blocks of bounded size (a block lies in one input partition). A block numbers its distinct
segments; its documents become arrays of these numbers. Only a block's distinct segments are shuffled by their text;
sorted, equal ones meet in one task and are encoded and aligned once. A segment has at most one row per block, so no key
is hot, however frequent the word. Alignments return to their blocks, and documents are composed of them:

1. each block counts in how many of its documents an id pair is linked, and these counts are summed by pair;
2. the sums return to the blocks that hold the pair, and each document adds up its links.

The blocks' documents move as arrays of numbers, twice; nothing else grows with the number of words. An alignment is the
ids of both sides and one step per link, which tells whose token ends with it; links, groups and their text follow from
running sums over the steps of a whole block.

Defined results. Null and empty texts, and texts that one tokenizer does not give back byte by byte (in such a model,
those that hold U+2581), have no tokens: zeros and an empty ``groups_sha256``; they link nothing. Null and repeated keys
stay rows of their own. Strings of special tokens inside texts are plain text. Whole texts of any length are aligned; one
without white space is one segment. An empty table gives an empty result. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import forget, freeing, small_batches, stored, table, tidy

# Unicode White_Space.
SPACE = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
BLOCK_BYTES = 12 << 20
#: Segment numbers of documents that are expanded at one time.
CHUNK = 1 << 19


def byte_alphabet() -> dict[str, int]:
    """Printable Latin-1 stands for itself, the other bytes follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers: where texts may be cut, and the alignment of one segment."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec.get("normalizer"):
            raise ValueError(f"not a plain byte-level file: {path_a}")
        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        back = byte_alphabet()
        self.bytes_a = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.bytes_a[i] = bytes(back[c] for c in token) if set(token) <= back.keys() else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        plain = [p.replace("▁", " ") for i, p in enumerate(pieces) if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_byte(i))]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.len_a, self.len_b = [len(x) for x in self.bytes_a], [len(x) for x in self.bytes_b]
        self.kind = "H" if max(len(self.bytes_a), len(self.bytes_b)) <= 1 << 16 else "I"
        crossed = {w for p in plain for x, w in zip(p, p[1:]) if w in SPACE and x not in SPACE}
        held = set().union(*plain)
        self.guard = next(c for c in map(chr, range(1, 32)) if c not in held)
        self.before = self.b.encode(self.guard)
        safe, unsafe = "".join(c for c in SPACE if c not in crossed), "".join(crossed)
        each = lambda cs: "".join(f"\\u{ord(c):04x}" for c in cs)
        space, other = f"[{each(SPACE)}]", f"[^{each(SPACE)}]"
        more = f"(?:[{each(unsafe)}]{space}*{other}*)*" if unsafe else ""
        self.segments = re.compile(f"(?:{space}+{other}*|{other}+){more}") if safe else re.compile(r"[\s\S]+")

    def encode(self, segments: list[str]) -> list[tuple[list[int], list[int]]]:
        a = self.a.encode_batch_fast(segments, add_special_tokens=False)
        b = self.b.encode([self.guard + s for s in segments], num_threads=1)
        n = len(self.before)
        if any(ids[:n] != self.before for ids in b):
            raise ValueError("the guard has merged with a segment")
        return [(x.ids, y[n:]) for x, y in zip(a, b)]

    def align(self, segment: str, a: list[int], b: list[int]) -> bytes | None:
        """One step per link, from left to right: 1 where only the token of A ends with it, 2 only that of B, 3 both.

        None if either tokenizer does not give the segment back.
        """
        raw = segment.encode()
        if b"".join([self.bytes_a[i] for i in a]) != raw or b"".join([self.bytes_b[i] for i in b]) != raw:
            return None
        if len(a) == 1 and len(b) == 1:
            return b"\x03"
        ends_a, ends_b = set(accumulate([self.len_a[i] for i in a])), set(accumulate([self.len_b[i] for i in b]))
        return bytes([(e in ends_a) + 2 * (e in ends_b) for e in sorted(ends_a | ends_b)])


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(path_a: str, path_b: str) -> Pair:
    """One per worker process and pair of files."""
    if (path_a, path_b) not in _PAIRS:
        _PAIRS[path_a, path_b] = Pair(path_a, path_b)
    return _PAIRS[path_a, path_b]


class Numbers(dict):
    """New keys get the next number."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers with their first bytes first, then the second ones, ...: small numbers compress well."""
    return np.ascontiguousarray(numbers.astype("<u4").view("u1").reshape(-1, 4).T).tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, "u1").reshape(4, -1).T).view("<u4").ravel()


def coded(docs: DataFrame, path_a: str, path_b: str, *, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Two kinds of rows: documents ``block, key, codes``, and the block's segments ``block, code, segment``."""
    kind = docs.schema[key].dataType.simpleString()
    names = ["block", "key", "codes", "code", "segment"]

    def run(batches):
        cut = pair_of(path_a, path_b).segments
        number, size, known, type_ = 0, 0, Numbers(), None
        task = TaskContext.get().partitionId() << 24

        def dictionary():
            m, words = len(known), list(known)
            for i in range(0, m, 1 << 14):
                part = words[i : i + (1 << 14)]
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, task + number)), pa.nulls(n, type_), pa.nulls(n, pa.binary()), pa.array(np.arange(i, i + n, dtype=np.int32)), pa.array(part, pa.string())], names
                )

        for batch in batches:
            type_ = batch.column(0).type
            for i in range(len(batch)):
                t = batch.column(1)[i].as_py()
                words = cut.findall(" " + t) if t else []
                codes = np.fromiter(map(known.__getitem__, words), np.uint32, len(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task + number]), batch.column(0).slice(i, 1), pa.array([_planes(codes)], pa.binary()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.string())], names
                )
                size += len(t or "")
                if size >= block_bytes:
                    yield from dictionary()
                    number, size, known = number + 1, 0, Numbers()
        yield from dictionary()

    return docs.select(F.col(key), F.col(text)).mapInArrow(freeing(_joined(run)), f"block long, key {kind}, codes binary, code int, segment string")


def _joined(run, rows: int = 256):
    """``run`` with its single rows put together to batches."""

    def inner(batches):
        held, n, size = [], 0, 0
        for b in run(batches):
            held.append(b)
            n, size = n + len(b), size + b.nbytes
            if n >= rows or size >= 4 << 20:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n, size = [], 0, 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return inner


def segment_alignments(segments: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``block, code, a, b, steps`` of rows ``block, code, segment``: ids of either side, two bytes each where both
    vocabularies allow it (else four), and the steps of ``Pair.align``; null for a segment that is not given back."""

    def run(batches):
        both = pair_of(path_a, path_b)
        last: dict[str, tuple] = {}  # the batch before ended with it
        for batch in batches:
            at = batch.column(2).dictionary_encode()
            words = at.dictionary.to_pylist()
            todo = [w for w in words if w not in last]
            done = dict(last)
            for w, (a, b) in zip(todo, both.encode(todo)):
                steps = both.align(w, a, b)
                done[w] = (None, None, None) if steps is None else (array(both.kind, a).tobytes(), array(both.kind, b).tobytes(), steps)
            if words:
                last = {words[-1]: done[words[-1]]}
            cols = list(zip(*(done[w] for w in words))) or [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.binary()).take(at.indices) for c in cols)], ["block", "code", "a", "b", "steps"])

    spark = segments.sparkSession
    rows = segments.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "segment").sortWithinPartitions("segment")
    return rows.select("block", "code", "segment").mapInArrow(freeing(run), "block long, code int, a binary, b binary, steps binary")


def _flat(table: pa.Table, name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of binaries, and how many each row has (null: none)."""
    rows = pa.concat_arrays(table.column(name).chunks or [pa.array([], pa.binary())])
    offsets = np.frombuffer(rows.buffers()[1], np.int32, len(rows) + 1, 4 * rows.offset) if len(rows) else np.zeros(1, np.int32)
    data = rows.buffers()[2]
    raw = np.frombuffer(data, "u1")[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, "u1")
    return np.frombuffer(raw.tobytes(), kind).astype(np.int64), np.diff(offsets).astype(np.int64) // np.dtype(kind).itemsize


def _by(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs."""
    run, ends = np.concatenate([[0], np.cumsum(values)]), np.cumsum(sizes)
    return run[ends] - run[ends - sizes]


class Block:
    """A block's documents (arrays of segment numbers) and its segments' alignments."""

    def __init__(self, docs: pa.Table, parts: pa.Table, kind: str):
        each = [_numbers(x.as_buffer()) for x in docs.column("codes").combine_chunks()] if len(docs) else []
        self.sizes = np.array([len(x) for x in each], np.int64)
        self.codes = np.concatenate(each).astype(np.int32) if each else np.zeros(0, np.int32)
        self.doc = np.repeat(np.arange(len(each), dtype=np.int32), self.sizes)
        parts = parts.sort_by("code")  # numbers run from 0 without gaps
        faithful = parts.column("steps").is_valid().to_numpy().astype(bool)
        (self.a, self.n_a), (self.b, self.n_b) = _flat(parts, "a", kind), _flat(parts, "b", kind)
        self.steps, self.n_links = _flat(parts, "steps", "u1")
        ends_a, ends_b = self.steps & 1, self.steps >> 1
        self.pairs = self.a[np.cumsum(ends_a) - ends_a] << 32 | self.b[np.cumsum(ends_b) - ends_b]
        self.n_groups = _by(self.steps == 3, self.n_links)
        bad = np.unique(self.doc[~faithful[self.codes]]) if len(self.codes) else np.zeros(0, np.int64)
        self.whole = self.sizes > 0
        self.whole[bad] = False

    def sums(self, by_code: np.ndarray) -> np.ndarray:
        """Per document, the sum of a number per segment."""
        return np.where(self.whole, _by(by_code[self.codes], self.sizes), 0)

    def _runs(self):
        """(first document, end, first segment number, end) of documents that have up to CHUNK segments together."""
        ends, i = np.cumsum(self.sizes), 0
        while i < len(ends):
            base = ends[i] - self.sizes[i]
            j = max(i + 1, int(np.searchsorted(ends, base + CHUNK, "right")))
            yield i, j, base, ends[j - 1]
            i = j

    def _texts(self) -> pa.Array:
        """Per segment, the text of its groups, each closed by a semicolon."""
        before = np.cumsum(self.steps == 3) - (self.steps == 3)
        group_a, group_b = before[self.steps & 1 > 0], before[self.steps >> 1 > 0]
        last = lambda g: np.append(g[1:] != g[:-1], True)[: len(g)]
        token, stop = np.empty(len(self.a) + len(self.b), np.int64), np.empty(len(self.a) + len(self.b), np.int64)
        at_a = np.arange(len(self.a)) + np.searchsorted(group_b, group_a, "left")
        at_b = np.arange(len(self.b)) + np.searchsorted(group_a, group_b, "right")
        token[at_a], token[at_b] = self.a, self.b
        stop[at_a], stop[at_b] = np.where(last(group_a), 1, 0), np.where(last(group_b), 2, 0)
        words = pc.binary_join_element_wise(pa.array(token).cast(pa.string()), pa.array([",", "|", ";"]).take(pa.array(stop)), "")
        offsets = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)]).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), words), "")

    def groups_hashes(self) -> list[str]:
        """Per document, the hash of its groups' text."""
        out, texts = [], self._texts()
        for i, j, first, end in self._runs():
            offsets = np.concatenate([[0], np.cumsum(self.sizes[i:j])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), texts.take(pa.array(self.codes[first:end])))
            for text, whole in zip(pc.binary_join(lists, ""), self.whole[i:j]):
                out.append(hashlib.sha256(memoryview(text.as_buffer())[:-1]).hexdigest() if whole else "")
        return out

    def pair_documents(self) -> tuple[np.ndarray, np.ndarray]:
        """The pairs linked in the block's documents, and in how many of them."""
        names, place = np.unique(self.pairs, return_inverse=True)
        n, first, m = np.zeros(len(names), np.int64), np.cumsum(self.n_links) - self.n_links, max(len(self.n_links), 1)
        for _, _, start, end in self._runs():
            at = np.arange(start, end)
            at = at[self.whole[self.doc[at]]]
            key = np.unique(self.doc[at].astype(np.int64) * m + self.codes[at])
            doc, code = key // m, key % m
            many = self.n_links[code]
            link = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[code], many)
            met = np.unique(np.repeat(doc, many) * len(names) + place[link])
            n += np.bincount(met % max(len(names), 1), minlength=len(names))
        return names[n > 0], n[n > 0]


def aligned(docs: DataFrame, path_a: str, path_b: str, *, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(per document ``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``; per linked id pair ``a, b,
    n`` documents and ``best``, whether no other pair of its ``a`` is in more)."""
    spark = docs.sparkSession
    tidy(spark)
    small_batches(spark, 64)
    kind = docs.schema[key].dataType.simpleString()
    rows = stored(coded(docs, path_a, path_b, key=key, text=text, block_bytes=block_bytes), "coded", "zstd")
    texts = rows.filter(F.col("codes").isNotNull()).select("block", "key", "codes")
    small_batches(spark, 10_000)
    parts = stored(segment_alignments(rows.filter(F.col("segment").isNotNull()).select("block", "code", "segment"), path_a, path_b), "parts", "zstd")

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        names, n = Block(left, right, pair_of(path_a, path_b).kind).pair_documents()
        block = right.column("block")[0].as_py() if len(right) else 0
        return pa.table({"block": pa.array(np.full(len(names), block)), "a": pa.array((names >> 32).astype(np.int32)), "b": pa.array((names & 0xFFFFFFFF).astype(np.int32)), "n": pa.array(n)})

    pairs = stored(texts.groupBy("block").cogroup(parts.groupBy("block")).applyInArrow(count, "block long, a int, b int, n long"), "pairs")
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"))
    counts = stored(counts, "counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    counts = counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))
    back = pairs.select("block", "a", "b").join(counts, ["a", "b"])
    null = lambda kind, *names: [F.lit(None).cast(kind).alias(c) for c in names]
    both = parts.select("*", *null("int", "first", "second"), *null("long", "n"), *null("boolean", "best")).unionByName(
        back.select("block", *null("int", "code"), *null("binary", "a", "b", "steps"), F.col("a").alias("first"), F.col("b").alias("second"), "n", "best")
    )

    def compose(left: pa.Table, right: pa.Table) -> pa.Table:
        is_pair = pc.is_valid(right.column("first"))
        sums = right.filter(is_pair)
        block = Block(left, right.filter(pc.invert(is_pair)), pair_of(path_a, path_b).kind)
        col = lambda c: sums.column(c).to_numpy().astype(np.int64)
        name = col("first") << 32 | col("second")
        order = np.argsort(name)
        known, n, best = name[order], col("n")[order], col("best")[order]
        if len(known):
            at = np.minimum(np.searchsorted(known, block.pairs), len(known) - 1)
            met = known[at] == block.pairs  # pairs of documents without tokens alone are not counted
            n, best = np.where(met, n[at], 0), np.where(met, best[at], 0)
        else:
            n = best = np.zeros(len(block.pairs), np.int64)
        by_code = {"n_a": block.n_a, "n_b": block.n_b, "n_groups": block.n_groups, "n_links": block.n_links, "n_best": _by(best, block.n_links), "count_sum": _by(n, block.n_links)}
        return pa.table({"key": left.column("key"), **{c: pa.array(block.sums(v)) for c, v in by_code.items()}, "groups_sha256": pa.array(block.groups_hashes(), pa.string())})

    schema = f"key {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    out = stored(texts.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(compose, schema), "aligned")
    for df in (rows, parts, pairs):
        forget(df)
    return out, counts


def op12_alignment(spark, sf_dir: str) -> DataFrame:
    """Query: how the tokens of two tokenizers meet in every document."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    out, _ = aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.withColumnRenamed("key", "doc_id")
