"""Op 6: near-duplicate detection by improved consistent weighted sampling over TF-IDF shingles.

A shingle is ``size`` consecutive words; a shorter text is one shingle. Its weight is its count in the text times
its IDF, the mean over its words of ``smooth + ln((1 + N) / (1 + df))``. The document frequency is counted for words,
hashed into ``2**IDF_BITS`` buckets over all documents, and not for shingles: a text copied thousands of times would
have thousands in every shared shingle and one in each edited shingle, and the edits would outweigh the text.

1. Every text draws ``bands * rows`` consistent weighted samples: for each hash function the shingle and quantized
   weight with the least value, so two texts agree in a sample with a probability of their weighted Jaccard
   similarity. Gamma and uniform draws are read off 64 hash bits through tables.
2. Equal texts (by 128 bits of their words) become one representative. Representatives that agree in all rows of a
   band share a bucket. Small buckets give their pairs. In larger ones each member meets the few members that agree
   most with all others; links verified so far make components, and members outside the bucket's largest one do so
   again as long as a round settles a tenth of them. Then those still outside meet, block by block, all members of
   other components: the samples tell which of them may be alike, and those are verified block against block.
3. Pairs whose samples let 0.8 seem possible are verified: weighted Jaccard over the whole texts. Only verified links
   settle a member, and no pair of a bucket is left out unless such links connect it.
4. Classes are the components of the verified links.

Plan. The samples are drawn where the texts lie; only hashes are shuffled. Leaders are repeated over salts, so a
bucket with a third of all rows spreads; blocks meet as single rows. Text is shuffled for documents in candidate
pairs alone. Members that no links connect cost the square of their number in arithmetic (a matrix product a pair of
blocks), but a pair of blocks returns at most one row a member, so rows and shuffle do not grow with that square.

Defined results. Null and empty texts, and those without words, are classes of their own. Equal rows share a class.
The class id is the least key in the class. Very long texts are compared whole. An empty table gives an empty result.
Other columns, whatever their names, are not carried.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm import textnum
from rivulet.llm.common import BROADCAST_BYTES, freeing, sized, small_batches, stored, table, tidy, work_dir
from rivulet.llm.components import components, spanning

IDF_BITS = 18
FAN_IN = 64
#: Buckets up to SMALL give their pairs; larger ones have rounds of LEADERS, each repeated over SALTS, then BLOCKs of
#: samples and, of members that may have a link there, TEXTS in a block and COLUMNS of a matrix at once.
SMALL, LEADERS, SALTS, BLOCK, TEXTS, COLUMNS = 8, 4, 16, 256, 128, 8192
#: A round of leaders is followed by another if it settles this share of the members that are left.
SETTLED = 0.1
_LINK = "a long, b long, similarity double"
_W1, _W2, _S = textnum.Poly(31), textnum.Poly(32), textnum.Poly(33)


def _gamma_table() -> np.ndarray:
    """Quantiles of Gamma(2, 1) at 65,536 even steps."""
    p = (np.arange(1 << 16) + 0.5) / (1 << 16)
    lo, hi = np.zeros(1 << 16), np.full(1 << 16, 40.0)
    for _ in range(60):
        x = (lo + hi) / 2
        below = 1 - np.exp(-x) * (1 + x) < p
        lo, hi = np.where(below, x, lo), np.where(below, hi, x)
    return (lo + hi) / 2


_GAMMA = _gamma_table()
_R, _LOG_C = _GAMMA.astype(np.float32), np.log(_GAMMA).astype(np.float32)


def shingles(words: textnum.Words, size: int, idf: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, weight, text) of the distinct shingles of a slice's texts, texts in order."""
    s, each, count, text = counted(words, size, idf)
    return s, each * count.astype(np.float32), text


def counted(words: textnum.Words, size: int, idf: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, IDF, count, text) of the distinct shingles of a slice's texts, texts in order."""
    h = words.hashes(_W1)
    at, text = words.runs(size)
    ends = at + size
    n_words = np.diff(words.first)
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        at = np.concatenate([at, words.first[short]])
        ends = np.concatenate([ends, words.first[short + 1]])
        text = np.concatenate([text, short])
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    s = _S.spans(h, at, ends)
    if idf is None:
        each = np.ones(len(at), np.float32)
    else:
        run = np.concatenate([[0.0], np.cumsum(idf[h >> np.uint64(64 - IDF_BITS)].astype(np.float64))])
        each = ((run[ends] - run[at]) / (ends - at)).astype(np.float32)
        each = np.round(each * 4096) / np.float32(4096)  # the running sum's last bits depend on where the text lies
    _, first, count = np.unique(s ^ textnum.mix(text.astype(np.uint64) + np.uint64(1)), return_index=True, return_counts=True)
    order = np.lexsort((first, text[first]))
    first, count = first[order], count[order]
    return s[first], each[first], count, text[first]


def samples(s: np.ndarray, weight: np.ndarray, text: np.ndarray, n: int, k: int) -> np.ndarray:
    """k consistent weighted samples (64-bit, 0 without shingles) of each of n texts."""
    out = np.zeros((n, k), np.uint64)
    if not len(s):
        return out
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    where = text[first]
    log_w = np.log(weight)
    for j in range(k):
        u = textnum.mix(s ^ np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        r = _R[u >> np.uint64(48)]
        low = u.astype(np.uint32)
        beta = low.astype(np.float32) * np.float32(2.0**-32)
        t = np.floor(log_w / r + beta)
        value = _LOG_C[(u >> np.uint64(32)).astype(np.uint16)] - r * (t - beta + np.float32(1))
        bits = value.view(np.int32)
        ordered = (bits ^ ((bits >> np.int32(31)) | np.int32(-(1 << 31)))).view(np.uint32)
        who = low ^ (t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1))
        out[where, j] = textnum.mix(np.minimum.reduceat((ordered.astype(np.uint64) << np.uint64(32)) | who, first))
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two (distinct hashes in order, weights)."""
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    hit = a[0][at] == b[0] if len(a[0]) else np.zeros(len(b[0]), bool)
    both = np.minimum(a[1][at[hit]], b[1][hit]).sum(dtype=np.float64)
    total = a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64) - both
    return float(both / total) if total else 0.0


def word_idf(docs: DataFrame, text: str, smooth: float) -> np.ndarray:
    """IDF of each word bucket over all documents; a table of fixed size."""
    size = 1 << IDF_BITS

    def count(batches):
        df, n = np.zeros(size, np.int64), 0
        for batch in batches:
            for _, words in textnum.slices(batch.column(0)):
                bucket = (words.hashes(_W1) >> np.uint64(64 - IDF_BITS)).astype(np.int64)
                owner = np.repeat(np.arange(len(words.offsets) - 1), np.diff(words.first))
                df += np.bincount(np.unique(owner << IDF_BITS | bucket) & (size - 1), minlength=size)
                n += len(words.offsets) - 1
        blob = zlib.compress(df.astype("<i8").tobytes(), 1)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([n], pa.int64()), pa.array([blob], pa.binary())], ["g", "n", "df"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size, np.int64)
        for b in pdf["df"]:
            total += np.frombuffer(zlib.decompress(b), "<i8")
        return pd.DataFrame({"g": pdf["g"].iloc[:1].to_numpy(), "n": [int(pdf["n"].sum())], "df": [zlib.compress(total.tobytes(), 1)]})

    level = docs.select(text).mapInArrow(count, "g long, n long, df binary")
    tasks, width = docs.rdd.getNumPartitions(), 1
    while width < max(tasks, 2):
        width *= FAN_IN
        level = level.withColumn("g", F.floor(F.col("g") / FAN_IN)).groupBy("g").applyInPandas(add, "g long, n long, df binary")
    rows = level.collect()  # one row
    if not rows:
        return np.full(size, smooth, np.float32)
    df = np.frombuffer(zlib.decompress(bytes(rows[0]["df"])), "<i8")
    return (smooth + np.log((1 + rows[0]["n"]) / (1 + df))).astype(np.float32)


def signatures(docs: DataFrame, idf, *, key: str, text: str, size: int, bands: int, rows: int) -> DataFrame:
    """``key, ha, hb`` (hashes of all words), ``sig`` (16 bits a sample), ``bh`` (a hash a band); texts with words only."""
    k = bands * rows

    def draw(batches):
        table_ = idf.value
        for batch in batches:
            for i, words in textnum.slices(batch.column(1), 1 << 18):
                n = len(words.offsets) - 1
                full = np.diff(words.first) > 0
                s, w, t = shingles(words, size, table_)
                sig = samples(s, w, t, n, k)[full]
                whole = [p.spans(q, words.first[:-1], words.first[1:])[full] for p, q in ((_S, words.hashes(_W1)), (_W1, words.hashes(_W2)))]
                b = np.zeros((len(sig), bands), np.uint64)
                for r in range(rows):
                    b = textnum.mix(b * np.uint64(3) + sig[:, r::rows])
                b ^= textnum.mix(np.arange(bands, dtype=np.uint64) + np.uint64(77))
                low = sig.astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, n).filter(pa.array(full)),
                        *[pa.array(x.view(np.int64)) for x in whole],
                        pa.array([x.tobytes() for x in low], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, b.size + 1, bands), pa.int32()), pa.array(b.view(np.int64).ravel())),
                    ],
                    ["key", "ha", "hb", "sig", "bh"],
                )

    return docs.select(F.col(key).cast("long"), text).mapInArrow(freeing(draw), "key long, ha long, hb long, sig binary, bh array<long>")


def _agreement(pairs: DataFrame, sig: DataFrame, k: int, low: float) -> DataFrame:
    """The ``pairs`` (``a, b``) of which a share of ``low`` or more of the samples is equal."""
    signed = pairs.join(sig.withColumnsRenamed({"key": "a", "sig": "sa"}), "a").join(sig.withColumnsRenamed({"key": "b", "sig": "sb"}), "b")

    def compare(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, k) for c in ("sa", "sb"))
                yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= low))

    return signed.select("a", "b", "sa", "sb").mapInArrow(compare, "a long, b long")


def _members(batch: pa.RecordBatch, name: str, k: int):
    """Of each row's array of members: their columns, samples as an array of k columns."""
    column = batch.column(name)
    edges, flat = column.offsets.to_numpy(), column.values
    for i, j in zip(edges[:-1], edges[1:]):
        part = flat.slice(i, j - i)
        cols = {f.name: part.field(f.name) for f in flat.type}
        sig = np.frombuffer(b"".join(cols.pop("sig").to_pylist()), "<u2").reshape(-1, k)
        yield sig, {n: c.to_numpy(zero_copy_only=False) for n, c in cols.items()}


def _central(blocks: DataFrame, k: int) -> DataFrame:
    """``bh, score, key``: of each block (``bh``, ``m``: its members) those that agree most with all the others."""

    def pick(batches):
        for batch in batches:
            bh, score, key = [], [], []
            for h, (sig, cols) in zip(batch.column("bh").to_pylist(), _members(batch, "m", k)):
                same = np.zeros(len(sig))
                for j in range(k):
                    _, at, n = np.unique(sig[:, j], return_inverse=True, return_counts=True)
                    same += n[at] - 1
                best = np.lexsort((cols["key"], -same))[:LEADERS]
                bh += [h] * len(best)
                score.append(same[best] / (k * max(1, len(sig) - 1)))
                key.append(cols["key"][best])
            if bh:
                yield pa.RecordBatch.from_arrays([pa.array(bh, pa.int64()), pa.array(np.concatenate(score)), pa.array(np.concatenate(key), pa.int64())], ["bh", "score", "key"])

    return blocks.select("bh", "m").mapInArrow(pick, "bh long, score double, key long")


def _touched(blocks: DataFrame, k: int, low: float) -> DataFrame:
    """``bh, key`` of members of two blocks (``x``, ``y``) with a share of ``low`` or more of equal samples with one of another label."""

    def meet(batches):
        for batch in batches:
            for h, (s, x), (t, y) in zip(batch.column("bh").to_pylist(), _members(batch, "x", k), _members(batch, "y", k)):
                equal = np.zeros((len(s), len(t)), np.uint8)
                for j in range(k):
                    equal += s[:, j, None] == t[None, :, j]
                alike = (equal >= low * k) & (x["label"][:, None] != y["label"][None, :])
                keys = np.concatenate([x["key"][alike.any(axis=1)], y["key"][alike.any(axis=0)]])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), h, np.int64)), pa.array(keys, pa.int64())], ["bh", "key"])

    return blocks.select("bh", "x", "y").mapInArrow(freeing(meet), "bh long, key long").distinct()


def common_weight(a: list[tuple], b: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weight that each two of the texts ``a`` and ``b`` share, and the whole weights; a text is (hash, IDF, count) of its shingles.

    A shingle's second, third, ... occurrences are shingles of their own, so the weights' minimum is a product.
    """
    def flat(texts):
        s, each, n = (np.concatenate([t[c] for t in texts]) for c in range(3))
        row = np.repeat(np.arange(len(texts)), [len(t[0]) for t in texts])
        i = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return textnum.mix(np.repeat(s, n) + i.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), np.repeat(each, n).astype(np.float64), np.repeat(row, n)

    (sa, wa, ra), (sb, wb, rb) = flat(a), flat(b)
    total = [np.bincount(r, w, len(t)) for r, w, t in ((ra, wa, a), (rb, wb, b))]
    both = np.intersect1d(sa, sb)
    out = np.zeros((len(a), len(b)))
    for first in range(0, len(both), COLUMNS):
        some = both[first : first + COLUMNS]
        sides = []
        for s, w, r, n in ((sa, wa, ra, len(a)), (sb, np.ones(len(sb)), rb, len(b))):
            at = np.minimum(np.searchsorted(some, s), len(some) - 1)
            hit = some[at] == s
            m = np.zeros((n, len(some)))
            m[r[hit], at[hit]] = w[hit]
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out, *total


def _linked(blocks: DataFrame, idf, size: int, threshold: float) -> DataFrame:
    """Links that connect the members of two blocks (``x``, ``y``: ``key, label, t``) whose whole texts are alike enough."""

    def meet(batches):
        table_ = idf.value

        def texts(column):
            edges, flat = column.offsets.to_numpy(), column.values
            vectors = []
            for _, words in textnum.slices(flat.field("t")):
                s, each, n, text = counted(words, size, table_)
                cut = np.searchsorted(text, np.arange(len(words.offsets)))
                vectors += [(s[i:j], each[i:j], n[i:j]) for i, j in zip(cut[:-1], cut[1:])]
            names = [flat.field(c).to_numpy(zero_copy_only=False) for c in ("key", "label")]
            for i, j in zip(edges[:-1] - edges[0], edges[1:] - edges[0]):
                yield vectors[i:j], *(n[i + edges[0] : j + edges[0]] for n in names)

        for batch in batches:
            for (va, ka, la), (vb, kb, lb) in zip(texts(batch.column("x")), texts(batch.column("y"))):
                both, ta, tb = common_weight(va, vb)
                sim = both / np.maximum(ta[:, None] + tb[None, :] - both, 1e-300)
                i, j = np.nonzero((sim >= threshold) & (la[:, None] != lb[None, :]))
                keep = spanning(la[i], lb[j])
                i, j = i[keep], j[keep]
                a, b = ka[i], kb[j]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64()), pa.array(sim[i, j])], ["a", "b", "similarity"])

    return blocks.select("x", "y").mapInArrow(freeing(meet), _LINK)


def _block_pairs(members: DataFrame, sizes: DataFrame, block: int, columns: list[str]) -> DataFrame:
    """``bh, x, y``: of each bucket, all pairs of a block of outside members and a block of any, as arrays of ``columns``.

    ``members``: ``bh, key, out, outside, inside`` and more; ``sizes``: ``bh, outside, inside``, one row a bucket.
    """
    outer, inner = F.ceil(F.col("outside") / block), F.ceil(F.col("inside") / block)
    h = F.xxhash64("key")
    number = F.when(F.col("out"), F.pmod(h, outer)).otherwise(outer + F.pmod(h, inner))
    dealt = members.select("bh", number.alias("block"), F.struct(*columns).alias("one"))
    blocks = stored(dealt.groupBy("bh", "block").agg(F.collect_list("one").alias("m")), "blocks")
    ids = sizes.select("bh", F.explode(F.sequence(F.lit(0).cast("long"), outer - 1)).alias("i"), (outer + inner - 1).alias("last"))
    ids = ids.select("bh", "i", F.explode(F.sequence("i", "last")).alias("j"))
    return ids.join(blocks.withColumnsRenamed({"block": "i", "m": "x"}), ["bh", "i"]).join(blocks.withColumnsRenamed({"block": "j", "m": "y"}), ["bh", "j"])


def near_links(reps: DataFrame, verify, verify_blocks, *, bands: int, rows: int, threshold: float) -> DataFrame:
    """Links ``a, b`` that ``verify`` (of pairs) and ``verify_blocks`` confirm among the representatives (``key, sig, bh``).

    Their components are those of all pairs that share a bucket, whose samples let ``threshold`` seem possible and that
    ``verify`` confirms: a pair is left out only if other confirmed links connect it.
    """
    spark = reps.sparkSession
    k = bands * rows
    low = max(0.0, threshold - 4 * (threshold * (1 - threshold) / k) ** 0.5)
    n_reps = reps.count()
    sig = reps.select("key", "sig")
    if n_reps * (2 * k + 32) <= BROADCAST_BYTES // 4:
        sig = F.broadcast(sig)
    active = reps.select("key", F.explode("bh").alias("bh"))
    buckets = stored(active.groupBy("bh").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    n_small, n_large = (buckets.filter(c).count() for c in (F.col("n") <= SMALL, F.col("n") > SMALL))
    small = active.join(sized(buckets.filter(F.col("n") <= SMALL).select("bh"), n_small, 24), "bh", "left_semi")
    x, y = small.select("bh", F.col("key").alias("a")), small.select("bh", F.col("key").alias("b"))
    pairs = x.join(y, "bh").filter("a < b").select("a", "b")
    if not n_large:
        return stored(verify(stored(_agreement(pairs.distinct(), sig, k, low), "pairs")), "links")

    large = stored(active.join(sized(buckets.filter(F.col("n") > SMALL), n_large, 32), "bh").select("bh", "key", "n"), "large")
    folder, left, level, n_left = work_dir(spark), large, 0, large.count()
    while True:
        # the members of a bucket that seem most like all the others meet every member left
        dealt = left.withColumn("block", F.pmod(F.xxhash64("key", F.lit(level)), F.ceil(F.col("n") / BLOCK)))
        blocks = dealt.join(sig, "key").groupBy("bh", "block").agg(F.collect_list(F.struct("key", "sig")).alias("m"))
        best = F.slice(F.sort_array(F.collect_list(F.struct("score", "key")), False), 1, LEADERS)
        leads = _central(blocks, k).groupBy("bh").agg(best.alias("best")).select("bh", F.col("best.key").alias("leads"))
        leads, on, members = stored(leads, "leads"), ["bh"], left
        if n_large * LEADERS * 32 <= BROADCAST_BYTES:
            leads = F.broadcast(leads)
        else:  # a hot bucket's members spread over salts
            leads, on = leads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["bh", "salt"]
            members = left.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
        met = members.join(leads, on).select("key", F.explode("leads").alias("lead")).filter("key <> lead").select(F.least("key", "lead").alias("a"), F.greatest("key", "lead").alias("b"))
        pairs = met if level else pairs.unionByName(met)
        verify(stored(_agreement(pairs.distinct(), sig, k, low), "pairs")).write.parquet(f"{folder}/{level}-links")
        links = spark.read.schema(_LINK).parquet(*[f"{folder}/{n}-links" for n in range(level + 1)])
        # a bucket whose members links connect is done; of the others, the members outside the largest component go on
        labels = components(links.select("a", "b")).withColumnRenamed("v", "key")
        state = stored(large.join(labels, "key", "left").select("bh", "key", F.coalesce("label", "key").alias("label")), "state")
        most = state.groupBy("bh", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("bh").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"))
        open_ = stored(most.select("bh", F.col("top.label").alias("main"), F.col("top.n").alias("inside"), (F.col("n") - F.col("top.n")).alias("outside")).filter("outside > 0"), "open")
        n_large = open_.count()
        joined = stored(state.join(sized(open_, n_large, 48), "bh").withColumn("out", F.col("label") != F.col("main")).drop("main"), "joined")
        left = joined.filter(F.col("out") & (F.col("outside") > SMALL)).select("bh", "key", F.col("outside").alias("n"))
        before, n_left, level = n_left, left.count(), level + 1
        if n_left > (1 - SETTLED) * before or not n_left:
            break
    # every member outside, in blocks, meets all members of its bucket that no links connect with it
    met = _block_pairs(joined.join(sig, "key"), open_.select("bh", "outside", "inside"), BLOCK, ["key", "label", "sig"])
    touched = stored(joined.drop("outside", "inside").join(_touched(met, k, low), ["bh", "key"], "left_semi"), "touched")
    sizes = touched.groupBy("bh").agg(F.sum(F.col("out").cast("long")).alias("outside"), F.sum((~F.col("out")).cast("long")).alias("inside"))
    verify_blocks(touched, stored(sizes, "sizes")).write.parquet(f"{folder}/last-links")
    return links.unionByName(spark.read.schema(_LINK).parquet(f"{folder}/last-links"))


def verified_blocks(docs: DataFrame, touched: DataFrame, sizes: DataFrame, idf, *, key: str, text: str, size: int, threshold: float) -> DataFrame:
    """Links ``a, b, similarity`` that connect the members ``bh, key, label, out`` of each bucket, by their whole texts."""
    ids = stored(touched.select("key").distinct(), "ids")
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("t")).join(sized(ids, ids.count(), 16), "key", "left_semi").dropDuplicates(["key"])
    members = touched.join(sized(sizes, sizes.count(), 48), "bh")
    met = _block_pairs(members.join(stored(texts, "texts"), "key"), sizes, TEXTS, ["key", "label", "t"])
    return _linked(met, idf, size, threshold)


def verified(docs: DataFrame, pairs: DataFrame, idf, *, key: str, text: str, size: int, threshold: float) -> DataFrame:
    """The ``pairs`` whose whole texts have a weighted Jaccard similarity of ``threshold`` or more, with it."""
    ids = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    n = pairs.count()
    ids = F.broadcast(ids) if n * 32 <= BROADCAST_BYTES else ids
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("t")).join(ids, "key", "left_semi").dropDuplicates(["key"])
    texts = stored(texts, "texts")
    both = pairs.join(texts.withColumnsRenamed({"key": "a", "t": "ta"}), "a").join(texts.withColumnsRenamed({"key": "b", "t": "tb"}), "b")

    def measure(batches):
        table_ = idf.value

        def vectors(column):
            out = []
            for _, words in textnum.slices(column):
                s, w, t = shingles(words, size, table_)
                edges = np.searchsorted(t, np.arange(len(words.offsets)))
                for i in range(len(words.offsets) - 1):
                    x, y = s[edges[i] : edges[i + 1]], w[edges[i] : edges[i + 1]]
                    order = np.argsort(x)
                    out.append((x[order], y[order]))
            return out

        for batch in batches:
            sim = [similarity(x, y) for x, y in zip(vectors(batch.column(2)), vectors(batch.column(3)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sim, pa.float64())], ["a", "b", "similarity"])

    return both.select("a", "b", "ta", "tb").mapInArrow(freeing(measure), "a long, b long, similarity double").filter(F.col("similarity") >= threshold)


def near_classes(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 5, threshold: float = 0.8, bands: int = 16, rows: int = 4, smooth: float = 8.0
) -> DataFrame:
    """``key, class_id`` for each distinct key (an integer column) of ``docs``; null keys are left out.

    Of rows that share a key the classes merge.
    """
    spark = docs.sparkSession
    small_batches(spark)
    tidy(spark)
    docs = docs.filter(F.col(key).isNotNull())
    idf = spark.sparkContext.broadcast(word_idf(docs, text, smooth))  # 2**IDF_BITS floats
    sigs = stored(signatures(docs, idf, key=key, text=text, size=size, bands=bands, rows=rows), "signatures")
    least = stored(sigs.groupBy("ha", "hb").agg(F.min("key").alias("rep")), "representatives")
    reps = stored(sigs.join(least.select(F.col("rep").alias("key"), "ha", "hb"), ["key", "ha", "hb"], "left_semi").dropDuplicates(["key", "ha", "hb"]).select("key", "sig", "bh"), "reps")
    how = {"key": key, "text": text, "size": size, "threshold": threshold}
    links = near_links(reps, lambda p: verified(docs, p, idf, **how), lambda t, n: verified_blocks(docs, t, n, idf, **how), bands=bands, rows=rows, threshold=threshold)
    copies = sigs.select("key", "ha", "hb").join(least, ["ha", "hb"]).filter(F.col("key") != F.col("rep"))
    star = copies.select(F.col("rep").alias("a"), F.col("key").alias("b")).unionByName(links.select("a", "b"))
    labels = components(star)
    return docs.select(F.col(key).cast("long").alias("key")).distinct().join(labels.withColumnRenamed("v", "key"), "key", "left").select(
        "key", F.coalesce("label", "key").alias("class_id")
    )


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class: the one with the least key. Rows without a key stay."""
    least = stored(near_classes(docs, key=key, text=text, **options).filter("key = class_id").select(F.col("key").alias("__k")), "kept")
    n = least.count()
    ids = F.broadcast(least) if n * 16 <= BROADCAST_BYTES else least
    kept = docs.filter(F.col(key).isNotNull()).join(ids, F.col(key).cast("long") == F.col("__k"), "left_semi")
    if docs.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").limit(1).count():
        first = Window.partitionBy(key).orderBy(text)
        kept = kept.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")
    return kept.unionByName(docs.filter(F.col(key).isNull()))


def op6_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: the near-duplicate class of every document."""
    return near_classes(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")
