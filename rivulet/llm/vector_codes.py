"""Op 11: vectors as one-byte codes per part, by Lloyd rounds that shuffle only what has changed.

A vector's components become whole numbers, its dimensions are cut into equal consecutive parts, and each part position
has a codebook of at most 256 entries. A round assigns every part to the nearest entry and then sets each entry to the
floored mean of its parts.

Plan. The state is a table of the rows with their codes, written once a round; the running sums and counts are whole
numbers, one row per part and entry (``parts * entries`` rows, whatever the corpus holds), so the codebook follows from
them exactly. After a round, only rows whose code differs from the one persisted before are read again: each task adds
its plus and minus contributions up in NumPy and sends one row per part and entry it met; their sum is added to the
running sums. The first round's contributions are all plus. Distances are taken as ``|c|^2 - 2 x.c`` in float64 as long
as that is exact (checked against the largest component), and in whole numbers of any size beyond.

Defined results. Rows with a null vector, or one that holds null or non-finite components, are dropped; so are vectors
whose length is no positive multiple of ``parts`` or differs from that of the smallest kept id. Whole numbers beyond 40
bits count as the largest of 40 bits, and
errors (and their sums) beyond 63 bits as the largest of 63. Null ids come last in the order that gives the first codebook, repeated ids are
rows of their own, told apart by their components there; equal rows are interchangeable. Fewer rows than entries make
a shorter codebook. Null labels form one group. An empty table gives an empty result. Other columns are not carried.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import forget, freeing, sized, stored, table, tidy

LARGEST = (1 << 40) - 1
#: Vectors whose distances are held at one time.
ROWS = 2048


def usable(vector: Column, parts: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & (F.size(vector) % parts == 0) & F.coalesce(finite, F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """Components as floored multiples of 1 / ``scale``."""
    top = F.lit(float(LARGEST))
    return F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * F.lit(float(scale)), -top), top)).cast("long"))


def closest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of ``x`` the nearest row of ``book`` (ties: the lower one) and the squared distance, exactly."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.float64 if 4 * x.shape[1] * most * most < 1 << 53 else object
    b, code, dist = book.astype(kind), np.empty(len(x), np.int64), np.empty(len(x), object if kind is object else np.int64)
    square = (b * b).sum(axis=1)
    step = ROWS if kind is np.float64 else 16
    for i in range(0, len(x), step):
        some = x[i : i + step].astype(kind)
        far = square - 2 * (some @ b.T)
        at = np.argmin(far, axis=1)
        code[i : i + step] = at
        dist[i : i + step] = far[np.arange(len(at)), at] + (some * some).sum(axis=1)
    return code, dist


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def assign(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``rows`` (``id, label, v, codes``) with the codes before as ``old``, the new ``codes`` and the ``error``.

    ``books`` is (parts, entries, length of a part). ``codes`` may be null: not assigned yet.
    """
    parts, _, width = books.shape

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(2))
            codes, error = np.empty((len(x), parts), np.int32), np.zeros(len(x), object)
            for p in range(parts):
                codes[:, p], dist = closest(x[:, p * width : (p + 1) * width], books[p])
                error += dist
            error = np.minimum(error, np.iinfo(np.int64).max).astype(np.int64) if len(x) else np.zeros(0, np.int64)
            new = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, parts, dtype=np.int32)), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], batch.column(3), new, pa.array(error)], ["id", "label", "v", "old", "codes", "error"])

    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"id {kind['id']}, label {kind['label']}, v array<long>, old array<int>, codes array<int>, error long"
    return rows.select("id", "label", "v", "codes").mapInArrow(freeing(run), schema)


def moved(state: DataFrame, parts: int, entries: int, width: int) -> DataFrame:
    """Plus and minus contributions of the parts whose code has changed: ``part, entry, n, sums``."""

    def run(batches):
        n = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        touched = np.zeros((parts, entries), bool)
        for batch in batches:
            x, new = _matrix(batch.column(0)), _matrix(batch.column(2))
            known = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            old = np.full(new.shape, -1, np.int64)
            if known.any():
                old[known] = _matrix(batch.column(1).drop_null())
            for p in range(parts):
                own = x[:, p * width : (p + 1) * width]
                for codes, sign in ((old[:, p], -1), (new[:, p], 1)):
                    at = np.flatnonzero((old[:, p] != new[:, p]) & (codes >= 0))
                    np.add.at(n[p], codes[at], sign)
                    np.add.at(sums[p], codes[at], sign * own[at])
                    touched[p, codes[at]] = True
        p, e = np.nonzero(touched)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(n[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"]
        )

    changed = state.filter(F.col("old").isNull() | (F.col("old") != F.col("codes"))).select("v", "old", "codes")
    each = changed.mapInArrow(freeing(run), "part int, entry int, n long, sums array<long>")
    total = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    out = each.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total)
    return out.select("part", "entry", "n", F.array(*[F.col(f"s{i}") for i in range(width)]).alias("sums"))


def product_codes(
    vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024
) -> tuple[DataFrame, np.ndarray]:
    """(``id, label, codes, error``, final codebooks (parts, entries, width)) of the usable rows."""
    tidy(vectors.sparkSession)
    v = F.col(vector)
    rows = vectors.filter(usable(v, parts)).select(F.col(key).alias("id"), F.col(label).alias("label"), whole(v, scale).alias("v"))
    order = [F.col("id").asc_nulls_last(), F.col("v")]
    head = rows.orderBy(*order).limit(1).collect()
    length = len(head[0]["v"]) if head else parts
    rows = rows.filter(F.size("v") == length)
    first = np.array([r["v"] for r in rows.orderBy(*order).limit(entries).collect()], np.int64).reshape(-1, length)
    width = length // parts
    books = np.stack([first[:, p * width : (p + 1) * width] for p in range(parts)])
    if not head:
        kind = {f.name: f.dataType.simpleString() for f in rows.schema}
        return vectors.sparkSession.createDataFrame([], f"id {kind['id']}, label {kind['label']}, codes array<int>, error long"), books
    n, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
    state = rows.withColumn("codes", F.lit(None).cast("array<int>"))
    for r in range(rounds):
        before, state = state, stored(assign(state, books), f"round{r}")
        if r:
            forget(before)
        for d in moved(state, parts, books.shape[1], width).collect():  # one row per part and entry at most
            n[d["part"], d["entry"]] += d["n"]
            sums[d["part"], d["entry"]] += np.array(d["sums"], np.int64)
        books = np.where(n[..., None] > 0, sums // np.maximum(n, 1)[..., None], books)
    last = stored(assign(state, books).select("id", "label", "codes", "error"), "codes")
    if rounds:
        forget(state)
    return last, books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Query: the code of every embedding, its error, and the error of its label's rows together."""
    out, books = product_codes(table(spark, sf_dir, "embeddings"))
    by_label = out.groupBy("label").agg(F.coalesce(F.try_sum("error"), F.lit((1 << 63) - 1)).alias("label_error"))
    n_labels = by_label.count()
    hexed = F.concat(*[F.lpad(F.lower(F.hex(F.col("codes")[p])), 2, "0") for p in range(4)])
    rows = out.select(F.col("id").alias("vec_id"), hexed.alias("code"), "error", "label")
    sums = by_label.withColumnRenamed("label", "__l")
    return rows.join(sized(sums, n_labels, 64), F.col("label").eqNullSafe(F.col("__l"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def oracle(rounds: int = 4) -> str:
    """The query in DuckDB, its rounds written out one after another."""
    steps = [
        """kept as (select vec_id, label, list_transform(embedding, lambda x: cast(floor(cast(x as double) * 1024) as bigint)) as v,
  row_number() over (order by vec_id) as r from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        "p as materialized (select vec_id, r, j as part, list_slice(v, j * 16 + 1, j * 16 + 16) as v from kept, range(4) as t(j))",
        "b0 as materialized (select part, r - 1 as entry, v as c from p where r <= 256)",
    ]
    near = """a{k} as materialized (select vec_id, part, v, unnest(best) from (select vec_id, part, v, min(struct_pack(
  d := cast(list_inner_product(v::double[], v::double[]) - 2 * list_inner_product(v::double[], c::double[]) + list_inner_product(c::double[], c::double[]) as bigint),
  entry := entry)) as best from p join b{k} using (part) group by vec_id, part, v))"""
    mean = """m{k} as (select part, entry, list(cast(floor(cast(s as double) / n) as bigint) order by i) as c from (
  select part, entry, i, sum(v[i]) as s, count(*) as n from a{k}, range(1, 17) as t(i) group by part, entry, i) group by part, entry),
b{j} as materialized (select b.part, b.entry, coalesce(m.c, b.c) as c from b{k} b left join m{k} m using (part, entry))"""
    for k in range(rounds):
        steps += [near.format(k=k), mean.format(k=k, j=k + 1)]
    steps.append(near.format(k=rounds))
    return f"""with {", ".join(steps)},
h as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) as codebooks_sha256 from b{rounds}),
e as (select vec_id, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(d) as bigint) as error from a{rounds} group by vec_id)
select e.vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from e join kept using (vec_id) cross join h"""


SQL = oracle()
