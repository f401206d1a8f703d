"""The corpus pipeline: each stage's decisions on its own input, and the whole run."""

import corpus_pipeline as P
from pyspark.sql import functions as F


def test_stages(spark, sf_dir, docs):
    at = docs
    seen = {}
    for name, stage in P.STAGES:
        out = P.stored(stage(spark, at, sf_dir), name)
        seen[name] = (at, out)
        if name != "packing":
            assert out.columns == P.COLUMNS
        at = out
    before, after = seen["language_id"]
    assert after.count() >= 0.97 * before.count()
    before, after = seen["line_dedup"]
    assert after.count() == before.count() and after.filter(F.length("text") != F.col("n_chars")).count() == 0
    before, after = seen["near_dedup"]
    assert after.select("doc_id").distinct().count() == after.count() < before.count()
    before, after = seen["mixing"]
    assert after.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    before, after = seen["packing"]
    assert after.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 1024
    assert P.run(spark, sf_dir).count() == after.count()


def test_boilerplate_over_unlike_texts_goes_and_copies_stay(spark, sf_dir):
    """A line of 5 % of a source's unlike texts goes; the lines of a text copied into 5 % of it stay."""
    rows = [(i, f"body {i}\nmenu" if i % 20 == 0 else f"body {i}", "en", "s", 0) for i in range(400)]
    rows += [(1000 + i, "copied text\nits second line", "en", "s", 0) for i in range(20)]
    out = dict(P.without_boilerplate(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), sf_dir).select("doc_id", "text").collect())
    assert all(out[i] == f"body {i}" for i in range(400)) and all(out[1000 + i] == "copied text\nits second line" for i in range(20))


def test_odd_inputs(spark, odd, nothing, sf_dir):
    for _, stage in P.STAGES:
        assert stage(spark, odd, sf_dir).count() >= 0
        assert stage(spark, nothing, sf_dir).count() == 0
