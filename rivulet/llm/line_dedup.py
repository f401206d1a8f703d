"""Op 1: line dedup by site-relative line frequency.

Documents of one site (host) that share a line make it boilerplate: for each site, the number of its documents
that hold the line is divided by the site's number of documents, and lines above a ratio are dropped.

Plan. Lines are keyed by two independent 64-bit hashes, so no text is shuffled for the counts; counts combine on
the map side first. A site's lines above the ratio are few however large the site is (at most its mean number of
lines per document divided by the ratio), so they become one array a site. That table joins the documents by
broadcast when its measured size is small; otherwise each site's array is repeated over ``salts`` salts and the
documents of a hot site spread over as many tasks.

A text that is copied into many of a site's documents is for near-duplicate detection to find and would otherwise lose
all its lines, so (``copies_once``) a group of equal texts counts once among a line's documents and once among the site's.

Defined results. Null text: kept as null, no lines. Null site: a site of its own. Empty lines (after trimming) are
never boilerplate. A line repeated inside one document counts once. Repeated rows stay, as rows of their own.
Extra columns pass through; names starting with ``__`` are reserved for the operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import let, sized, stored


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _digest(line: Column) -> Column:
    t = F.trim(line)
    return F.struct(F.xxhash64(t).alias("a"), F.xxhash64(F.lit(7), t).alias("b"))


def boilerplate(
    docs: DataFrame, *, text: str = "text", site: str = "source", max_ratio: float = 0.02, min_pages: int = 5, copies_once: bool = True
) -> DataFrame:
    """One row per (site, line digest) above the ratio: ``__site, pages, site_pages, a, b``.

    With ``copies_once`` both numbers count a site's distinct texts instead of its documents.
    """
    base = docs.select(F.col(site).alias("__site"), F.col(text).alias("__text"))
    whole = F.struct(F.xxhash64("__text").alias("a"), F.xxhash64(F.lit(7), "__text").alias("b"))
    pages = base.select("__site", whole.alias("__x")).distinct() if copies_once else base
    totals = pages.groupBy("__site").agg(F.count(F.lit(1)).alias("site_pages"))
    digests = F.array_distinct(
        F.transform(F.filter(_lines(F.col("__text")), lambda x: F.trim(x) != ""), _digest)
    )
    held = base.select("__site", *([whole.alias("__x")] if copies_once else []), F.explode(digests).alias("d"))
    counts = (
        (held.distinct() if copies_once else held)
        .groupBy("__site", F.col("d.a").alias("a"), F.col("d.b").alias("b"))
        .agg(F.count(F.lit(1)).alias("pages"))
        .filter(F.col("pages") >= min_pages)
    )
    t = totals.withColumnRenamed("__site", "__t")
    return (
        counts.join(t, F.col("__site").eqNullSafe(F.col("__t")))
        .filter(F.col("pages") > F.lit(max_ratio) * F.col("site_pages"))
        .select("__site", "pages", "site_pages", "a", "b")
    )


def drop_boilerplate(
    docs: DataFrame,
    *,
    text: str = "text",
    site: str = "source",
    max_ratio: float = 0.02,
    min_pages: int = 5,
    copies_once: bool = True,
    salts: int = 64,
    detail: bool = False,
) -> DataFrame:
    """``docs`` with boilerplate lines removed from ``text``; with ``detail`` also ``n_lines`` and ``n_dropped``,
    in place of columns of these names.

    A line goes when more than ``max_ratio`` of its site's documents, and at least ``min_pages``, hold it;
    with ``copies_once`` equal texts count as one document.
    """
    if detail:
        docs = docs.drop("n_lines", "n_dropped")
    bad = stored(
        boilerplate(docs, text=text, site=site, max_ratio=max_ratio, min_pages=min_pages, copies_once=copies_once)
        .groupBy("__site")
        .agg(F.collect_list(F.struct("a", "b")).alias("__bad")),
        "boilerplate",
    )
    size = bad.agg(F.count(F.lit(1)), F.sum(F.size("__bad"))).first()
    sites, lines = size[0], size[1] or 0
    tagged = docs
    if sites * 64 + lines * 24 > 32 << 20:
        bad = bad.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        tagged = docs.withColumn("__salt", F.pmod(F.xxhash64(F.col(text)), F.lit(salts)).cast("int"))
        on = F.col(f"__d.{site}").eqNullSafe(F.col("__b.__site")) & (F.col("__d.__salt") == F.col("__b.__salt"))
    else:
        bad = sized(bad, sites * 64 + lines * 24, 1)
        on = F.col(f"__d.{site}").eqNullSafe(F.col("__b.__site"))
    marked = tagged.alias("__d").join(bad.alias("__b"), on, "left").select(
        *[F.col(f"__d.{c}") for c in docs.columns], F.col("__b.__bad").alias("__bad")
    )

    def pruned(lines: Column) -> Column:
        kept = F.filter(lines, lambda x: ~F.array_contains(F.col("__bad"), _digest(x)))
        return F.struct(
            F.array_join(kept, "\n").alias("text"),
            F.size(lines).cast("long").alias("n"),
            (F.size(lines) - F.size(kept)).cast("long").alias("dropped"),
        )

    whole = F.struct(
        F.col(text).alias("text"),
        F.coalesce(F.size(_lines(F.col(text))), F.lit(0)).cast("long").alias("n"),
        F.lit(0).cast("long").alias("dropped"),
    )
    new = F.when(F.col("__bad").isNull() | F.col(text).isNull(), whole).otherwise(
        let(_lines(F.col(text)), pruned)
    )
    out = marked.withColumn("__new", new)
    cols = [F.col("__new.text").alias(c) if c == text else F.col(c) for c in docs.columns]
    if detail:
        cols += [F.when(F.col(text).isNull(), 0).otherwise(F.col("__new.n")).cast("long").alias("n_lines"),
                 F.col("__new.dropped").alias("n_dropped")]
    return out.select(*cols)


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: every document with the digest of what stays of it."""
    from rivulet.llm.common import table

    out = drop_boilerplate(table(spark, sf_dir, "documents"), detail=True)
    return out.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("kept_sha256")
    )


#: DuckDB's form of the query, by the whole line instead of its digests.
SQL = r"""
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
tot AS (SELECT source, count(*) AS n FROM (SELECT DISTINCT source, text FROM documents) GROUP BY source),
l AS (SELECT DISTINCT source, text, trim(u) AS line FROM (SELECT source, text, unnest(ls) AS u FROM d)),
bad AS (
  SELECT l.source, l.line FROM l JOIN tot ON l.source IS NOT DISTINCT FROM tot.source
  WHERE l.line <> '' GROUP BY l.source, l.line, tot.n
  HAVING count(*) >= 5 AND count(*) > 0.02 * tot.n),
g AS (SELECT source, list(line) AS bl FROM bad GROUP BY source)
SELECT d.doc_id,
  coalesce(len(d.ls), 0)::BIGINT AS n_lines,
  coalesce(len(list_filter(d.ls, lambda x: list_contains(coalesce(g.bl, []), trim(x)))), 0)::BIGINT AS n_dropped,
  sha256(coalesce(array_to_string(list_filter(d.ls,
    lambda x: NOT list_contains(coalesce(g.bl, []), trim(x))), chr(10)), '')) AS kept_sha256
FROM d LEFT JOIN g ON d.source IS NOT DISTINCT FROM g.source
"""
