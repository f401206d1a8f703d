"""Op 7: language identification by averaged hashed subword embeddings and a linear softmax, with rejection.

A text's subwords are its 2-, 3- and 4-grams of lower-case UTF-8 bytes, everything but letters standing as a blank.
Their hashes pick rows of an embedding table; the mean row goes through a linear softmax. Both are trained by
stochastic gradient descent in NumPy on the driver, on a bounded sample of labelled rows (``per_label`` texts a
label, chosen by a hash of the key). A part of the sample is kept back: on it a temperature calibrates the
probabilities, and the rejection threshold is their ``reject`` quantile among right answers, at most 0.5.

Plan. Since mean and softmax are linear up to the end, embedding times weights is one score table of fixed size
(buckets x labels), which is broadcast; every whole text is then scored where it lies, without a shuffle.

Defined results. ``und`` with score 0, rejected, if the text is null or has no letter. Ties go to the label first in
code-point order. Without any labelled row every text is ``und``. Repeated rows are scored each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm import textnum
from rivulet.llm.common import freeing, give_back, small_batches, table

ORDERS = (2, 3, 4)
BITS = 17
UND = "und"
_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[97:123] = np.arange(97, 123)
_PLAIN[128:] = np.arange(128, 256)


def subwords(words: textnum.Words, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every subword of the texts in a slice, texts in order."""
    b = _PLAIN[words.buf].astype(np.uint32)
    owner = np.repeat(np.arange(len(words.offsets) - 1, dtype=np.int32), np.diff(words.offsets))
    buckets, texts = [], []
    for n in ORDERS:
        if len(b) < n:
            continue
        m = len(b) - n + 1
        gram = np.zeros(m, np.uint32)
        solid = np.zeros(m, bool)
        for j in range(n):
            gram = (gram << np.uint32(8)) | b[j : j + m]
            solid |= b[j : j + m] != 32
        ok = solid & (owner[:m] == owner[n - 1 :])
        h = (gram[ok] ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
        buckets.append(((h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits)).astype(np.int32))
        texts.append(owner[:m][ok])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    bucket, text = np.concatenate(buckets), np.concatenate(texts)
    order = np.argsort(text, kind="stable")
    return bucket[order], text[order]


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray  # buckets x labels: embedding times weights
    bias: np.ndarray
    temperature: float
    threshold: float


def _means(rows: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, rows.shape[1]), np.float32)
    if len(text):
        first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
        count = np.diff(np.append(first, len(text)))
        out[text[first]] = np.add.reduceat(rows, first, axis=0) / count[:, None]
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(
    texts: list[str], langs: list[str], *, dim: int = 16, bits: int = BITS, min_steps: int = 1500, rate: float = 2.0, batch: int = 16, kept_back: float = 0.2, reject: float = 0.001, seed: int = 5
) -> Model:
    """Fits embeddings and softmax; the rows' order decides what is kept back, so equal input gives equal models."""
    labels = sorted(set(langs))
    y = np.array([labels.index(x) for x in langs], np.int64)
    grams: list[tuple[np.ndarray, np.ndarray]] = []  # distinct buckets and their shares, text by text
    for _, words in textnum.slices(pc.utf8_lower(pa.array(texts, pa.large_string()))):
        bucket, text = subwords(words, bits)
        edges = np.searchsorted(text, np.arange(len(words.offsets)))
        for i in range(len(words.offsets) - 1):
            u, c = np.unique(bucket[edges[i] : edges[i + 1]], return_counts=True)
            grams.append((u, (c / max(1, c.sum())).astype(np.float32)))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    n_back = min(int(len(texts) * kept_back), len(texts) - 1)
    back, fit = order[:n_back], order[n_back:]
    emb = rng.normal(0, 0.1, (1 << bits, dim)).astype(np.float32)
    w = rng.normal(0, 0.1, (dim, len(labels))).astype(np.float32)
    bias = np.zeros(len(labels), np.float32)

    def hidden(ids):
        u = np.concatenate([grams[i][0] for i in ids])
        share = np.concatenate([grams[i][1] for i in ids])
        row = np.repeat(np.arange(len(ids)), [len(grams[i][0]) for i in ids])
        h = np.zeros((len(ids), dim), np.float32)
        if len(u):
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            h[row[first]] = np.add.reduceat(emb[u] * share[:, None], first, axis=0)
        return h, u, share, row

    epochs = -(-min_steps * batch // max(1, len(fit)))  # few rows are met more often
    total = max(1, epochs * -(-len(fit) // batch))
    done = 0
    for _ in range(epochs):
        rng.shuffle(fit)
        for s in range(0, len(fit), batch):
            ids = fit[s : s + batch]
            h, u, share, row = hidden(ids)
            g = _softmax(h @ w + bias)
            g[np.arange(len(ids)), y[ids]] -= 1
            step = rate * (1 - done / total)
            gh = g @ w.T
            w -= step / len(ids) * (h.T @ g)
            bias -= 0.1 * step / len(ids) * g.sum(axis=0)
            np.add.at(emb, u, -step * share[:, None] * gh[row])
            done += 1
    model = Model(labels, emb @ w, bias, 1.0, 0.0)
    if len(back):
        z = np.concatenate([hidden(back[i : i + batch])[0] for i in range(0, len(back), batch)]) @ w + bias  # a batch's subwords at a time
        grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
        loss = [-np.log(np.maximum(_softmax(z / t)[np.arange(len(back)), y[back]], 1e-12)).mean() for t in grid]
        model.temperature = float(max(grid[int(np.argmin(loss))], 0.25))
        p = _softmax(z / model.temperature)
        right = p.argmax(axis=1) == y[back]
        if right.any():
            model.threshold = float(min(0.5, np.quantile(p.max(axis=1)[right], reject)))
    return model


def sample(docs: DataFrame, *, key: str, text: str, lang: str, per_label: int) -> tuple[list[str], list[str]]:
    """At most about ``per_label`` labelled texts of each label, chosen by a hash of the key; a fixed order."""
    labelled = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counts = {r[0]: r[1] for r in docs.filter(F.col(lang).isNotNull()).groupBy(lang).count().collect()}
    if not counts:
        return [], []
    share = F.lit(0.0)
    for name, n in counts.items():  # one entry a language
        share = F.when(F.col(lang) == name, F.lit(min(1.0, per_label / n))).otherwise(share)
    draw = (F.pmod(F.xxhash64(F.lit(11), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    rows = labelled.filter(draw < share).select(F.xxhash64(F.col(key)).alias("h"), F.col(lang).alias("l"), F.col(text).alias("t")).collect()
    rows.sort(key=lambda r: (r["h"], r["l"], r["t"]))
    return [r["t"] for r in rows], [r["l"] for r in rows]


def identify(docs: DataFrame, model: Model | None, *, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred, score, accepted``; columns of these names are replaced."""
    docs = docs.drop("lang_pred", "score", "accepted")
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # buckets x labels floats
    at = docs.columns.index(text)

    def score(batches):
        m = shared.value
        for batch in batches:
            n = batch.num_rows
            pred, conf = np.full(n, UND, object), np.zeros(n)
            ok = np.zeros(n, bool)
            col = batch.column(at)
            if m is not None and n:
                letters = pc.match_substring_regex(col, r"\pL").fill_null(False).to_numpy(zero_copy_only=False)
                for i, words in textnum.slices(pc.utf8_lower(col)):
                    k = len(words.offsets) - 1
                    bucket, owner = subwords(words, int(m.table.shape[0]).bit_length() - 1)
                    p = _softmax((_means(m.table[bucket], owner, k) + m.bias) / m.temperature)
                    best = p.argmax(axis=1)
                    pred[i : i + k] = np.array(m.labels, object)[best]
                    conf[i : i + k] = p[np.arange(k), best]
                pred[~letters], conf[~letters] = UND, 0.0
                ok = letters & (conf >= m.threshold)
            cols = [*batch.columns, pa.array(pred, pa.string()), pa.array(np.clip(conf, 0, 1)), pa.array(ok)]
            yield pa.RecordBatch.from_arrays(cols, [*batch.schema.names, "lang_pred", "score", "accepted"])

    fields = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(freeing(score), f"{fields}, lang_pred string, score double, accepted boolean")


def fitted(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", per_label: int = 800) -> Model | None:
    """A model from a bounded sample of ``docs``; None without labels."""
    texts, langs = sample(docs, key=key, text=text, lang=lang, per_label=per_label)
    model = train(texts, langs) if texts else None
    del texts, langs
    give_back()  # the sample and its subwords; the driver goes on with other work
    return model


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    """Query: the language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fitted(docs.filter(~held_out(F.col("doc_id"))))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")
