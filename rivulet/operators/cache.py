"""A content-addressed cache: what was made of equal inputs is made once, and an entry is used only if its digest holds.

Entries are appended, never changed, so two writers at a time cannot harm each other: both may make an entry of one key, and
readers take the same one of them. An entry is ``key`` (SHA-256 over the version and the inputs' canonical JSON), ``value``
(text) and ``value_sha`` over both. Other versions have other keys, so a stale entry is never met; a damaged one fails its
digest, counts as absent and is made anew beside it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTRY = "key string, value string, value_sha string"


def key_of(inputs: list[str], version: str) -> Column:
    """Null inputs are part of the key; columns count by name, not by order."""
    body = F.to_json(F.struct(*[F.col(c) for c in sorted(inputs)]), {"ignoreNullFields": "false"})
    return F.sha2(F.concat_ws("\n", F.lit(version), body), 256)


def digest() -> Column:
    return F.sha2(F.concat_ws("\n", "key", "value"), 256)


def entries(df: DataFrame, inputs: list[str], value: str, version: str) -> DataFrame:
    """Entries of rows that hold their value."""
    return df.select(key_of(inputs, version).alias("key"), F.col(value).alias("value")).withColumn("value_sha", digest())


def valid(spark, path: str) -> DataFrame:
    """``key, value`` of the entries that hold, one a key; a damaged file's rows fail their digests. No table: none."""
    try:
        rows = spark.read.schema(ENTRY).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "key string, value string")
    held = rows.filter(F.col("value").isNotNull() & (F.col("value_sha") == digest()))
    return held.groupBy("key").agg(F.min("value").alias("value"))


def cached(df: DataFrame, path: str, inputs: list[str], make: Callable[[DataFrame], DataFrame], value: str, version: str) -> DataFrame:
    """``df`` with ``value`` (text) and ``hit``: from the cache at ``path`` where an entry holds, else made and added.

    ``make`` gets the distinct inputs without an entry and returns them with ``value``; a null value is made again each time.
    """
    spark = df.sparkSession
    named = df.withColumn("__key", key_of(inputs, version))
    before = valid(spark, path)
    missing = named.select("__key", *inputs).dropDuplicates(["__key"]).join(before.select(F.col("key").alias("__key")), "__key", "left_anti")
    made = entries(make(missing.drop("__key")), inputs, value, version)
    fresh = f"{path.rstrip('/')}-new/{uuid.uuid4().hex}"  # noted before the append, or a later read would call the new ones hits
    made.write.parquet(fresh)
    new = spark.read.schema(ENTRY).parquet(fresh)
    new.write.mode("append").parquet(path)
    after = valid(spark, path).withColumnRenamed("key", "__key").withColumnRenamed("value", value)
    found = named.join(after, "__key", "left").join(new.select(F.col("key").alias("__key"), F.lit(True).alias("__new")).distinct(), "__key", "left")
    return found.withColumn("hit", F.col("__new").isNull() & F.col(value).isNotNull()).select(*df.columns, value, "hit")
