"""Incremental collection as a stream: new rows are upserted batch by batch, exactly once for each key and batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.store import CorpusStore


def upsert_stream(rows: DataFrame, store: CorpusStore, table: str, checkpoint: str, available_now: bool = True):
    """Start the query that upserts a stream of rows into a table of the store, each batch once.

    A batch's commit carries its number and the stream's id, which is that of the checkpoint. Spark repeats at most the last
    batch before a restart, so the first batch of a start is looked up among the marks; others are new. What another writer
    has put since into a batch's keys is thus not overwritten by the repeat.
    """
    started = False

    def put(batch: DataFrame, number: int) -> None:
        nonlocal started
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        mark = f"{stream}/{number}"
        if (started or store.marked(table, mark) is None) and not batch.isEmpty():
            store.upsert(table, batch, mark, fresh=True)
        started = True

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def first_seen(events: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Rows of a stream whose key has not come within ``delay``: the skip-existing rule with bounded state."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def counts_by_window(
    events: DataFrame, time: str = "ts", width: str = "1 hour", delay: str = "1 hour", by: str = "event_type"
) -> DataFrame:
    """Progress counts by window; the same plan runs on a table or on a stream."""
    rows = events.withWatermark(time, delay) if events.isStreaming else events
    return rows.groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), by, "n"
    )


def read_stream(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.readStream.schema(like.schema).parquet(path)
