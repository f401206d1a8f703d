"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: A side of a join is broadcast only when its measured row count times its row width is below this.
BROADCAST_BYTES = 32 << 20


def work_dir(spark: SparkSession) -> str:
    """A folder of this call in the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent and all tasks run in this process (tests, a notebook) a folder under /tmp serves;
    on a cluster an absent setting is an error, since executors do not share their local folders.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "/tmp/checkpoints"
    return f"{base.rstrip('/')}/rivulet-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "t", compression: str = "snappy") -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: cuts lineage, survives lost executors."""
    path = f"{work_dir(df.sparkSession)}/{name}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if ``rows * row_bytes`` is small; Spark shuffles (and splits skew) otherwise."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, though the body uses it often inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_words(text: Column) -> Column:
    """Number of words; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches of few rows and bytes, so that very long texts do not meet in one batch.

    Results are lazy, so the setting stays for the session.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    except Exception:  # a version without the setting
        return


def give_back() -> None:
    """Gives memory that this process has freed back to the system."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def freeing(run):
    """``run`` (a map over Arrow batches) that gives its memory back to the system when a task ends."""

    def inner(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(spark: SparkSession) -> None:
    """Shuffle files go when the query that made them ends, instead of whenever the driver collects its garbage."""
    for name in ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.shuffleDependency.fileCleanup.enabled"):
        try:
            spark.conf.set(name, "true")
        except Exception:  # a version without the setting
            continue


def forget(df: DataFrame) -> None:
    """Deletes the work table that ``stored`` wrote for ``df``, once nothing reads it any more; other tables stay."""
    files = df.inputFiles()
    folder = files[0].rsplit("/", 1)[0] if files else ""
    if not re.search(r"/rivulet-[0-9a-f]{32}/[^/]*$", folder):
        return
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
