"""Op 2: best-fit packing of documents into token sequences, after Martello-Toth dominance reduction.

Every document is its token ids and an end id. A longer one than a sequence is cut into full pieces, the first of
which may be shorter. Lengths are whole numbers up to the capacity, so the instance is a histogram with at most
``capacity`` entries, however many documents there are. The packing is found on that histogram:

1. Reduction: a largest open length ``a`` is settled for good where some set provably dominates all others it could
   share a bin with: nothing fits beside it; its exact complement exists; no three fit and ``b`` is the largest
   partner; or no four fit and the largest partner is at least as long as the best two partners together.
2. The rest is packed best fit, longest first, many equal bins at once.

Plan. Tokens are counted where the texts lie; only (key, piece, length) goes on. The pieces of one length are
numbered by hash buckets (row_number inside a bucket plus the counts of the buckets before), so a length that a third
of all pieces share is spread over as many tasks as it has rows for. The plan of at most a few thousand bin patterns
joins by broadcast: its size is bounded by the capacity, not by the data.

Defined results. Null text: empty, so one piece with the end id alone. Repeated rows are documents of their own.
An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import freeing, small_batches, stored, table

# The pre-tokenizer's white space (Unicode White_Space) and contractions.
SPACE_POINTS = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: The pre-tokenizer's expression, as the file's kind of pre-tokenizer has it.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _bytes_of_chars() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _class(chars) -> str:
    """A character class for the code points given, as ranges."""
    out, run = [], []
    for c in [*chars, -2]:
        if run and c == run[-1] + 1:
            run = [run[0], c]
        else:
            if run:
                out.append(f"{re.escape(chr(run[0]))}-{re.escape(chr(run[-1]))}")
            run = [c]
    return "".join(out)


class Tokens:
    """Ids of whole texts, as the tokenizers library gives them for a byte-level BPE file without added ids.

    Whole texts go to tiktoken with the same expression and the same vocabulary as ranks, which needs merges in the order
    of ids. Its expressions give up on runs of about a million white-space characters; such a text is cut here. For any
    other file the tokenizers library encodes whole texts.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        back = _bytes_of_chars()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        ids = [vocab.get("".join(p), -1) for p in pairs]
        self.fast = (
            all(set(t) <= back.keys() for t in vocab if t not in self.specials)
            and all(a < b for a, b in zip(ids, ids[1:]))
            and spec.get("normalizer") is None
            and spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        )
        if not self.fast:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(path)
            return
        import tiktoken

        ranks = {bytes(back[c] for c in t): i for t, i in vocab.items() if t not in self.specials}
        self.encoding = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        other = _class(c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("Nl", "No"))
        space = _class(SPACE_POINTS)
        self.pieces = re.compile(
            rf"{CONTRACTIONS}| ?[^\W\d_{other}]+| ?[\d{other}]+| ?(?:[^\w{space}]|_)+|[{space}]+(?![^{space}])|[{space}]+"
        )
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None

    def _plain(self, text: str) -> bytes:
        try:
            return self.encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        except ValueError:  # too long a run for tiktoken's expressions
            return b"".join(np.array(self.encoding._encode_single_piece(x), "<u4").tobytes() for x in self.pieces.findall(text))

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not self.fast:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self.special is None or "<" not in text:
            return self._plain(text)
        return b"".join(
            np.array([self.specials[x]], "<u4").tobytes() if x in self.specials else self._plain(x)
            for x in self.special.split(text)
        )


_TOKENS: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    """One per worker process and file."""
    if path not in _TOKENS:
        _TOKENS[path] = Tokens(path)
    return _TOKENS[path]


def token_pieces(
    docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 2, with_ids: bool = False
) -> DataFrame:
    """One row per piece: ``key, piece, start, length, ids_crc32`` and, if asked, ``ids``."""
    small_batches(docs.sparkSession)

    def cut(batches):
        tok = tokens(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for k, t in enumerate(batch.column(1)):
                ids = tok.ids(t.as_py() or "") + end
                n = len(ids) // 4
                at, to = 0, (n - 1) % capacity + 1
                piece = 0
                while at < n:
                    part = ids[4 * at : 4 * to]
                    for out, v in zip(rows, (k, piece, at, to - at, zlib.crc32(part), part)):
                        out.append(v)
                    at, to, piece = to, to + capacity, piece + 1
            cols = [
                batch.column(0).take(pa.array(rows[0], pa.int64())),
                pa.array(rows[1], pa.int32()),
                *[pa.array(x, pa.int64()) for x in rows[2:5]],
            ]
            names = ["key", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array([np.frombuffer(b, "<u4").astype("i8") for b in rows[5]], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return docs.select(F.col(key), F.col(text)).mapInArrow(freeing(cut), schema)


def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Bins settled by dominance, as (lengths, how many), and the counts that remain."""
    left = {s: n for s, n in sorted(counts.items()) if n}
    fixed: list[tuple[tuple[int, ...], int]] = []

    def settle(*sizes: int) -> None:
        need = {s: sizes.count(s) for s in sizes}
        n = min(left[s] // k for s, k in need.items())
        fixed.append((sizes, n))
        for s, k in need.items():
            left[s] -= n * k
            if not left[s]:
                del left[s]

    for a in sorted(left, reverse=True):
        while left.get(a):
            order = sorted(left)
            room = capacity - a
            avail = lambda s, taken=(): left.get(s, 0) - (s == a) - sum(x == s for x in taken)
            fits = [s for s in order[: bisect_right(order, room)] if avail(s) > 0]
            if not fits:
                settle(a)
                continue
            best = fits[-1]
            if best == room:
                settle(a, best)
                continue
            low = [s for s in fits[:3] for _ in range(min(3, avail(s)))][:3]
            if len(low) < 2 or low[0] + low[1] > room:
                settle(a, best)
                continue
            if len(low) < 3 or sum(low) > room:  # three may fit with a, four may not
                pairs = [
                    s + t
                    for s in fits
                    if (i := bisect_right(fits, room - s))
                    and (t := next((x for x in reversed(fits[:i]) if avail(x, (s,)) > 0), None)) is not None
                ]
                if best >= max(pairs, default=0):
                    settle(a, best)
                    continue
            break
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counted lengths: bins of one pattern are filled together."""
    open_: dict[int, list[list]] = {}  # room -> [pattern, how many]
    done = []
    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            room = min((r for r in open_ if r >= s), default=None)
            if room is None:
                k = capacity // s  # new bins take this length as often as it fits
                pattern, take = ((s,) * k, n // k) if n >= k else ((s,) * n, 1)
                n -= take * len(pattern)
                rest = capacity - s * len(pattern)
            else:
                group = open_[room][-1]
                take = min(n, group[1])
                pattern, rest = (*group[0], s), room - s
                n -= take
                group[1] -= take
                if not group[1]:
                    open_[room].pop()
                    if not open_[room]:
                        del open_[room]
            (open_.setdefault(rest, []) if rest else done).append([pattern, take])
    return [(tuple(p), n) for p, n in [*done, *(g for gs in open_.values() for g in gs)]]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, end rank, sequence of the first rank, offset) that place every ranked piece."""
    fixed, left = reduce_dominated(counts, capacity)
    used: dict[int, int] = {}
    out, seq = [], 0
    for pattern, n in [*fixed, *best_fit(left, capacity)]:
        at = 0
        for s in pattern:
            first = used.get(s, 0)
            used[s] = first + n
            out.append((s, first, first + n, seq, at))
            at += s
        seq += n
    return out


def pack(pieces: DataFrame, *, capacity: int = 1024, bucket_rows: int = 500, max_buckets: int = 4096) -> DataFrame:
    """``pieces`` (with ``key, piece, length``; read more than once) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    rows = plan(counts, capacity)
    where = spark.createDataFrame(rows, "s_ long, first_ long, end_ long, seq_ long, offset long") if rows else spark.createDataFrame(
        [], "s_ long, first_ long, end_ long, seq_ long, offset long")
    n_buckets = min(max_buckets, max(1, -(-max(counts.values(), default=0) // bucket_rows)))
    named = pieces.withColumn("__b", F.pmod(F.xxhash64("key", "piece", "ids_crc32"), F.lit(n_buckets)))
    before = (
        named.groupBy("length", "__b")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("__before", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select(F.col("length").alias("l_"), F.col("__b").alias("b_"), "__before")
    )
    order = Window.partitionBy("length", "__b").orderBy("key", "piece", "start", "ids_crc32")
    ranked = named.withColumn("__rank", F.row_number().over(order)).join(
        before, (F.col("length") == F.col("l_")) & (F.col("__b") == F.col("b_"))
    )
    rank = F.col("__before") + F.col("__rank") - 1
    placed = ranked.withColumn("__rank", rank).join(
        F.broadcast(where),  # bounded by the capacity
        (F.col("length") == F.col("s_")) & (F.col("__rank") >= F.col("first_")) & (F.col("__rank") < F.col("end_")),
    )
    return placed.select(
        *pieces.columns, (F.col("seq_") + F.col("__rank") - F.col("first_")).alias("sequence_id"), "offset"
    )


def packed(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Tokenizes, cuts and packs ``docs``."""
    pieces = stored(token_pieces(docs, tokenizer, key=key, text=text, capacity=capacity, end_id=end_id, with_ids=with_ids), "pieces")
    return pack(pieces, capacity=capacity)


def sequences(packed_ids: DataFrame) -> DataFrame:
    """One row per sequence with the ids of all its pieces in place (needs ``with_ids``)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed_ids.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))


def op2_pack(spark, sf_dir: str) -> DataFrame:
    """Query: the place of every piece of every document."""
    import public_tokenizers

    out = packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(F.col("key").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
