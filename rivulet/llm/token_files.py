"""Op 13: token ids as files of independent zstandard frames with a trailing seek table.

A file is a run of frames in the public seekable form of zstandard, so any zstandard reader can decompress it whole:

* data frames, each decompressed on its own, hold the ids of consecutive documents, little-endian unsigned, two bytes
  each where the vocabulary allows it, else four. A document longer than a frame goes on in the next ones;
* a skippable frame with the document table (compressed): the file's number, the width of an id, and for each
  document its key and its number of ids;
* a skippable frame with the seek table: for each frame its size, its decompressed size and a checksum of its content
  (low 32 bits of XXH64), then the number of frames and the format's magic number.

A reader takes the end of the file, then the document table, then only the frames that the wanted documents lie in.

Plan. Texts are encoded where they lie; only ids move. Borders of equally many documents come from the keys alone
(quantiles, a fixed number of them); a key that fills several ranges is spread over them. Each task sorts its range and
writes as many files as its ids need, one row a file, through Spark's own writer: its commit protocol keeps half
written files of lost tasks out, and it reaches any store Spark reaches. Reading takes whole files from Spark (a file is
bounded by ``file_bytes`` and one document) and decompresses what is asked for. A document's first id counts the ids of
the files before it, summed file by file inside a range and range by range.

Defined results. Null text: empty, so the end id alone. Null keys come first. Repeated rows are documents of their own;
those of one key follow each other in any order. Keys are whole numbers. An empty table makes no document (and perhaps no
file). Other columns are not carried. Whole texts of any length are encoded; strings of special tokens inside a text are
single tokens, as is the library's default.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.llm.alignment import byte_alphabet
from rivulet.llm.common import freeing, sized, small_batches, stored, table, tidy, work_dir

# Fixed values of the seekable zstandard format.
SKIPPABLE, SEEK_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, bytes.fromhex("b1ea928f")
CHECKSUMS = 0x80
FRAME_BYTES = 1 << 16
FILE_BYTES = 1 << 24
# The pattern of the usual lower-case word files; the precomposed Latin letters (and ASCII) that normal form,
# lower case and the pattern treat one by one.
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
SIMPLE_WORD = re.compile("[!-~À-ÖØ-öø-ÿĀ-įı-ſ]+")
SIMPLE_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿā-įı-ſ]+|[0-9]|[^a-zß-öø-ÿā-įı-ſ0-9]+")
#: Words (and pieces of words) a worker remembers the ids of; beyond, those met first stay.
CACHE_WORDS = 500_000
CACHE_WORD_BYTES = 64


class WordIds:
    """Ids of whole texts as the tokenizers library gives them, each distinct word encoded once per worker.

    Where the file's rules see no further than the next ASCII white space (normalization by character, a pattern that
    matches no white space, no added token that holds or strips any), the words between are encoded apart; for any
    other file whole texts are. Words of ASCII and precomposed Latin letters are cut into the pattern's pieces here, and
    the library's model encodes each distinct piece once; all others go through the library as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.width = 2 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.apart = self._by_words(spec)
        self.simple = self.apart and spec["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex") == PATTERN and [s["type"] for s in spec["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
        self.special = re.compile("|".join([re.escape(t["content"]) for t in spec.get("added_tokens", [])]) or r"(?!)")
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.letters = {b: ord(c) for c, b in byte_alphabet().items()}

    @staticmethod
    def _by_words(spec: dict) -> bool:
        norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        steps = norm.get("normalizers", [norm] if norm else [])
        if any(s["type"] not in ("NFC", "Lowercase") and s != {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "} for s in steps):
            return False
        cuts = pre.get("pretokenizers", [])
        if len(cuts) != 2 or cuts[0]["type"] != "Split" or (cuts[0]["behavior"], cuts[0]["invert"]) != ("Removed", True) or cuts[1]["type"] != "ByteLevel":
            return False
        if cuts[1]["add_prefix_space"] or cuts[1]["use_regex"] or spec.get("post_processor"):
            return False
        # alternatives that are plain characters, classes without white space, or classes that exclude it
        if not all(re.fullmatch(r"'\w+|\[\\p\{[LN]\}\]\+?|\[\^\\s[^\]]*\]\+", x) for x in cuts[0]["pattern"].get("Regex", " ").split("|")):
            return False
        return not any(t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in spec.get("added_tokens", []))

    def _pack(self, ids: list[int]) -> bytes:
        return array("H" if self.width == 2 else "I", ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            letters = piece.encode().decode("latin-1").translate(self.letters)
            ids = self.pieces[piece] = self._pack([t.id for t in self.library.model.tokenize(letters)])
        return ids

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        out, todo = {}, []
        for w in words:
            text = w.decode()
            if self.simple and SIMPLE_WORD.fullmatch(text) and not self.special.search(text):
                out[w] = b"".join([self._piece(x) for x in SIMPLE_PIECE.findall(text.lower())])
            else:
                todo.append(w)
        coded = self.library.encode_batch_fast([w.decode() for w in todo], add_special_tokens=False) if todo else []
        return out | {w: self._pack(c.ids) for w, c in zip(todo, coded)}

    def many(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, ``width`` bytes each."""
        if not self.apart:
            yield from (self._pack(self.library.encode(t, add_special_tokens=False).ids) for t in texts)
            return
        for t in texts:
            words = t.encode().split()
            ids = list(map(self.known.get, words))
            if None in ids:
                new = self._learn({w for w, i in zip(words, ids) if i is None})
                ids = [new[w] if i is None else i for w, i in zip(words, ids)]
                self.known.update((w, i) for w, i in new.items() if len(w) <= CACHE_WORD_BYTES)
            yield b"".join(ids)
            if len(self.known) > CACHE_WORDS:  # frequent words are met early
                self.known = dict(islice(self.known.items(), CACHE_WORDS // 2))
            if len(self.pieces) > CACHE_WORDS:
                self.pieces = dict(islice(self.pieces.items(), CACHE_WORDS // 2))


_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per worker process and file."""
    if path not in _IDS:
        _IDS[path] = WordIds(path)
    return _IDS[path]


# -- the file --------------------------------------------------------------------------------------------------------


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


def _check(content: bytes) -> int:
    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


class FileBuilder:
    """One file, document by document."""

    def __init__(self, width: int, number: tuple[int, int], frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.width, self.number, self.frame_bytes = width, number, frame_bytes - frame_bytes % width
        self.press = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.frames: list[bytes] = []
        self.entries: list[tuple[int, int, int]] = []
        self.open, self.raw = bytearray(), 0
        self.keys: list[int | None] = []
        self.lengths: list[int] = []

    def _frame(self, content: bytes) -> None:
        self.frames.append(self.press.compress(content))
        self.entries.append((len(self.frames[-1]), len(content), _check(content)))

    def add(self, key: int | None, ids: bytes) -> None:
        self.keys.append(key)
        self.lengths.append(len(ids) // self.width)
        self.raw += len(ids)
        if self.open and len(self.open) + len(ids) > self.frame_bytes:  # a document that fits in a frame is never cut
            self._frame(bytes(self.open))
            self.open.clear()
        if len(ids) > self.frame_bytes:
            for i in range(0, len(ids), self.frame_bytes):
                self._frame(ids[i : i + self.frame_bytes])
        else:
            self.open += ids

    def finish(self) -> bytes:
        """The whole file."""
        if self.open:
            self._frame(bytes(self.open))
        null = np.array([k is None for k in self.keys], "u1")
        keys = np.array([k or 0 for k in self.keys], "<i8")
        content = struct.pack("<IIQQ", 1, self.width, *self.number) + null.tobytes() + keys.tobytes() + np.array(self.lengths, "<i8").tobytes()
        documents = _skippable(SKIPPABLE, self.press.compress(content))
        entries = [*self.entries, (len(documents), 0, _check(b""))]
        seek = b"".join(struct.pack("<III", *e) for e in entries) + struct.pack("<IB", len(entries), CHECKSUMS) + SEEKABLE
        return b"".join([*self.frames, documents, _skippable(SEEK_TABLE, seek)])


class TokenFile:
    """Reads one file through ``read(offset, size)``; decompresses only the frames that are asked for."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read = read
        n, flags, magic = struct.unpack("<IB4s", read(size - 9, 9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        seek = np.frombuffer(read(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(seek[:, 0])])
        self.at, self.sizes, self.sums = at[:-1], seek[:-1, :2], seek[:-1, 2]
        self.raw = np.concatenate([[0], np.cumsum(seek[:-1, 1])])
        self.unpress, self.decompressed = zstandard.ZstdDecompressor(), 0
        content = self.unpress.decompress(read(int(at[n - 1]) + 8, int(seek[-1, 0]) - 8))
        _, self.width, *self.number = struct.unpack("<IIQQ", content[:24])
        n = (len(content) - 24) // 17
        null = np.frombuffer(content, "u1", n, 24)
        keys = np.frombuffer(content, "<i8", n, 24 + n)
        self.lengths = np.frombuffer(content, "<i8", n, 24 + 9 * n)
        self.keys = [None if x else int(k) for x, k in zip(null, keys)]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.last: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self.last[0] != k:
            content = self.unpress.decompress(self.read(int(self.at[k]), int(self.sizes[k, 0])))
            if len(content) != self.sizes[k, 1] or _check(content) != self.sums[k]:
                raise ValueError(f"frame {k} is damaged")
            self.decompressed += 1
            self.last = (k, content)
        return self.last[1]

    def ids(self, i: int) -> np.ndarray:
        """Ids of the file's i-th document."""
        lo, hi = (int(self.starts[i] + x) * self.width for x in (0, self.lengths[i]))
        first, out = int(np.searchsorted(self.raw, lo, "right")) - 1, []
        while lo < hi:
            content, base = self.frame(first), int(self.raw[first])
            out.append(content[lo - base : hi - base])
            lo, first = base + len(content), first + 1
        return np.frombuffer(b"".join(out), f"<u{self.width}").astype("<u4")


def opened(file) -> TokenFile:
    """Of a binary file object."""

    def read(at: int, n: int) -> bytes:
        file.seek(at)
        return file.read(n)

    return TokenFile(read, file.seek(0, 2))


# -- Spark -----------------------------------------------------------------------------------------------------------


def encoded(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", end_id: int = 2) -> DataFrame:
    """``key long, n long, ids binary`` per document, the end id included."""
    small_batches(docs.sparkSession)

    def run(batches):
        coder = word_ids(tokenizer)
        end = np.array([end_id], f"<u{coder.width}").tobytes()
        for batch in batches:
            for i in range(0, len(batch), 64):
                part = batch.slice(i, 64)
                ids = [x + end for x in coder.many([t or "" for t in part.column(1).to_pylist()])]
                n = pa.array([len(x) // coder.width for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), n, pa.array(ids, pa.binary())], ["key", "n", "ids"])

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(freeing(run), "key long, n long, ids binary")


def write(docs: DataFrame, path: str, tokenizer: str, *, key: str = "doc_id", text: str = "text", end_id: int = 2, ranges: int | None = None, frame_bytes: int = FRAME_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Writes the ids of all documents under ``path``, in ascending order of the key over ranges and files."""
    spark = docs.sparkSession
    tidy(spark)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    inner = [(i + 1) / ranges for i in range(ranges - 1)]
    borders = docs.agg(F.percentile_approx(by, F.array(*map(F.lit, inner)), 100_000).alias("b")).first()["b"] if inner else []
    borders = sorted(borders or [])
    rows = encoded(docs, tokenizer, key=key, text=text, end_id=end_id)
    if borders:
        edge, own = F.array(*[F.lit(b) for b in borders]), F.coalesce("key", F.lit(-(1 << 63)))
        low, high = (F.size(F.filter(edge, f)) for f in (lambda b: b < own, lambda b: b <= own))
        rows = rows.withColumn("range", low + F.pmod(F.xxhash64("n", "ids"), high - low + 1).cast("int"))
    else:
        rows = rows.withColumn("range", F.lit(0))
    dealt = rows.repartitionById(ranges, F.col("range")).sortWithinPartitions("range", F.col("key").asc_nulls_first(), "n")

    def build(batches):
        width, file, number = word_ids(tokenizer).width, None, 0
        for batch in batches:
            for r, k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if file is not None and file.raw >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([file.finish()[: -len(SEEKABLE)]], pa.binary())], ["file"])
                    file, number = None, number + 1
                file = file or FileBuilder(width, (r, number), frame_bytes)
                file.add(k, ids.as_py())
        if file is not None:
            yield pa.RecordBatch.from_arrays([pa.array([file.finish()[: -len(SEEKABLE)]], pa.binary())], ["file"])

    files = dealt.select("range", "key", "ids").mapInArrow(freeing(build), "file binary")
    # one row a file; the writer ends a row with the line separator, here the format's last four bytes
    files.select(F.col("file").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", SEEKABLE.decode("latin1")).text(path)


def _in_memory(value: pa.Scalar) -> TokenFile:
    raw = value.as_buffer()
    return TokenFile(lambda at, n: raw[at : at + n].to_pybytes(), len(raw))


def _contents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``path, range, file, place, key, local, n, ids_crc32`` of every document, from the files; every frame is checked."""
    small_batches(spark, 4)

    def run(batches):
        for batch in batches:
            for path, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                file = _in_memory(value)
                m = len(file.keys)
                crc = [zlib.crc32(file.ids(i).tobytes()) for i in range(m)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * m), *(pa.array([x] * m, pa.int32()) for x in file.number)] + [pa.array(range(m), pa.int32()), pa.array(file.keys, pa.int64()), *(pa.array(x, pa.int64()) for x in (file.starts, file.lengths, crc))],
                    ["path", "range", "file", "place", "key", "local", "n", "ids_crc32"],
                )

    return _contents(spark, path).select("path", "content").mapInArrow(freeing(run), "path string, range int, file int, place int, key long, local long, n long, ids_crc32 long")


def with_starts(index: DataFrame) -> DataFrame:
    """The index (read more than once) with ``start``: the ids of all documents before, over all files."""
    spark = index.sparkSession
    files = index.groupBy("range", "file").agg(F.sum("n").alias("total"))
    ranges = {r["range"]: r["total"] for r in files.groupBy("range").agg(F.sum("total").alias("total")).collect()}  # as many as ``ranges`` of ``write``
    first, base = 0, []
    for r in sorted(ranges):
        base.append((r, first))
        first += ranges[r]
    inside = F.sum("total").over(Window.partitionBy("range").orderBy("file")) - F.col("total")
    bases = spark.createDataFrame(base, "range int, base long")
    starts = files.withColumn("inside", inside).join(F.broadcast(bases), "range").select("range", "file", (F.col("base") + F.col("inside")).alias("first"))
    return index.join(sized(starts, starts.count(), 32), ["range", "file"]).withColumn("start", F.col("first") + F.col("local")).drop("first")


def read_documents(spark: SparkSession, path: str, wanted: DataFrame, index: DataFrame) -> DataFrame:
    """``key, ids`` of the documents whose key is in ``wanted`` (column ``key``); only files that hold them are read, and only
    their frames decompressed. A file lists at most the documents that fit in ``file_bytes``."""
    small_batches(spark, 4)
    where = index.join(wanted.select("key").distinct(), "key", "left_semi").groupBy("path").agg(F.sort_array(F.collect_list("place")).alias("places"))

    def run(batches):
        for batch in batches:
            for value, places in zip(batch.column(0), batch.column(1).to_pylist()):
                file = _in_memory(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file.keys[i] for i in places], pa.int64()), pa.array([file.ids(i) for i in places], pa.list_(pa.int64()))], ["key", "ids"]
                )

    rows = _contents(spark, path).join(sized(where, where.count(), 1 << 10), "path").select("content", "places")
    return rows.mapInArrow(freeing(run), "key long, ids array<long>")


def op13_token_files(spark, sf_dir: str) -> DataFrame:
    """Query: place, length and checksum of every document's ids, as read back from the files."""
    import public_tokenizers

    path = f"{work_dir(spark)}/token_files"
    write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    index = stored(read_index(spark, path), "index")
    return with_starts(index).select(F.col("key").alias("doc_id"), "start", F.col("n").alias("n_tokens"), "ids_crc32")
