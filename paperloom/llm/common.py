"""Shared plumbing of the training-data operators: shared work folders, file systems, columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import shared

#: ASCII white space of the contracts; words are runs of anything else.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


#: Rows in an Arrow batch: whole texts go to Python, and a batch of them is held on both sides.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of at most BATCH_ROWS from here on: plans are run later, so the setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS or int(spark.conf.get(name)) <= 0:
        spark.conf.set(name, str(BATCH_ROWS))


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared root."""
    small_batches(spark)
    return shared.folder(spark, name)


def cut(spark: SparkSession, df: DataFrame, path: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends at replicated files. Copies of whole
    texts are worth ``zstd``."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store through Spark's own file system layer."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def open_fs(uri: str):
    """(pyarrow file system, path) of a shared folder, for files that are not tables."""
    from pyarrow import fs

    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri.removeprefix("file:")


def tidy() -> None:
    """Give memory that a Python worker no longer uses back to the system: workers live on, idle, between tasks."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def task(run):
    """``run`` for mapInArrow, with ``tidy`` at the end of each task."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            tidy()

    return wrapped
