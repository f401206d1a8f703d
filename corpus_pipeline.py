"""A training corpus from raw documents: language ID, line dedup, near-dedup, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import language_id, line_dedup, mixing, near_dedup, packing
from rivulet.llm.common import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognized; the others go."""
    model = language_id.fitted(docs)
    return language_id.identify(docs.select(*COLUMNS), model).filter("accepted").select(*COLUMNS)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the boilerplate lines of its source."""
    out = line_dedup.drop_boilerplate(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate class."""
    return near_dedup.keep_one(docs.select(*COLUMNS))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight takes them."""
    return mixing.mix(docs.select(*COLUMNS))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of 1024 tokens."""
    import public_tokenizers

    out = packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return out.withColumnRenamed("key", "doc_id")


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_boilerplate),
    ("near_dedup", one_of_each),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]
#: SQL cannot express the trained model, the sampling or the packing; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
