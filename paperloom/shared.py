"""The folder that driver and executors share, and tables written there to end a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset, a local session gets a folder of its own; a cluster has to name one."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="paperloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """``df`` as a Parquet table: every later read sees the same rows."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a work folder that no plan reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
