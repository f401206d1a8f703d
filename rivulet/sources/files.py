"""Readers and writers: JSON with fixed schemas, last-wins NDJSON, file listings, guarded and versioned outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_json(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = True) -> DataFrame:
    """JSON under an explicit schema; a malformed document fails the read."""
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


def unknown_keys(spark: SparkSession, path: str, allowed: list[str]) -> DataFrame:
    """``key`` of top-level JSON keys that are not allowed (for fail-closed inputs)."""
    raw = spark.read.text(path, wholetext=True)
    keys = raw.select(F.explode(F.json_object_keys("value")).alias("key")).distinct()
    return keys.filter(~F.col("key").isin(allowed))


def read_ndjson_last(spark: SparkSession, path: str, schema: StructType | str, key: str) -> DataFrame:
    """Newline-delimited JSON, blank lines skipped; of rows with one key the last stays.

    Last is by the file's name, then by the place in it: splits of a file may be read in any order, lines of a split are not.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("s")).filter(F.trim("value") != "")
    rows = lines.select(F.from_json("value", schema if isinstance(schema, str) else schema.simpleString(), {"mode": "FAILFAST"}).alias("r"), F.struct("f", "s", F.monotonically_increasing_id().alias("n")).alias("p"))
    return rows.groupBy(F.col(f"r.{key}").alias("k")).agg(F.max(F.struct("p", "r")).alias("m")).select("m.r.*")


def list_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """``path, name, sha256, length`` of files; equal stems get _2, _3, ... in path order."""
    from pyspark.sql import Window

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    stem = F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1)
    out = files.select("path", stem.alias("stem"), F.sha2("content", 256).alias("sha256"), "length")
    n = F.row_number().over(Window.partitionBy("stem").orderBy("path"))
    return out.withColumn("__n", n).select("path", F.when(F.col("__n") == 1, F.col("stem")).otherwise(F.concat("stem", F.lit("_"), "__n")).alias("name"), "sha256", "length")


def first_existing(spark: SparkSession, candidates: list[str]) -> str:
    """The first path that exists in its file system; an error if none does."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for c in candidates:
        p = jvm.org.apache.hadoop.fs.Path(c)
        if p.getFileSystem(conf).exists(p):
            return c
    raise FileNotFoundError(", ".join(candidates))


def write_once(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Refuses to write where output exists."""
    df.write.mode("errorifexists").format(fmt).save(path)


def replace(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Whole new content; Spark's committer moves finished files in at the end."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_summary_csv(df: DataFrame, path: str) -> None:
    """A report as one CSV file that starts with a byte order mark (for spreadsheets)."""
    header = "﻿" + ",".join(df.columns)
    body = df.select(F.to_csv(F.struct(*[F.col(c).cast("string") for c in df.columns])).alias("value"), F.lit(1).alias("o"))
    head = df.sparkSession.range(1).select(F.lit(header).alias("value"), F.lit(0).alias("o"))
    head.unionByName(body).coalesce(1).sortWithinPartitions("o").select("value").write.mode("overwrite").text(path)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``old`` without the keys of ``new``, and ``new``."""
    return old.join(new.select(key), key, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def packet(fields: DataFrame, names: list[str], placeholder: str = "READ_ME") -> DataFrame:
    """Field columns with a placeholder where nothing could be read."""
    return fields.withColumns({n: F.coalesce(F.nullif(F.trim(n), F.lit("")), F.lit(f"{placeholder}:{n}")) for n in names})
