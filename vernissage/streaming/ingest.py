"""Incremental runs as streams of files that stop when nothing is left.

The checkpoint folder holds what was read, so a run that dies is taken up where
it stopped; sinks are idempotent because each batch replaces whole crawls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vernissage.operators.merge import Store


def ingest(spark: SparkSession, source: str, schema: str, store: Store, checkpoint: str, max_files: int = 1000) -> None:
    """Publishes new snapshot files batch by batch, then rebuilds the latest state.

    A crawl may arrive in several batches: its earlier rows are kept.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true").parquet(source)
    q = stream.writeStream.foreachBatch(lambda batch, _: store.publish(batch, replace=False)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    store.compact()


def distinct_stream(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First event of each key; state older than the watermark is dropped."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(stream: DataFrame, event_time: str, by: Sequence[str], size: str, slide: str | None = None, delay: str = "0 seconds", **aggs: Column) -> DataFrame:
    """Counts (and further aggregates) per event-time window; late events are dropped past the delay."""
    w = F.window(event_time, size, slide) if slide else F.window(event_time, size)
    out = stream.withWatermark(event_time, delay).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n"), *[c.alias(n) for n, c in aggs.items()])
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", *aggs)


def sessions(df: DataFrame, event_time: str, by: Sequence[str], gap: str) -> DataFrame:
    """Sessions of events with no pause longer than ``gap``; works on streams and tables."""
    s = df.groupBy(F.session_window(event_time, gap).alias("w"), *by).agg(F.count("*").alias("n"))
    return s.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def run_to_table(stream: DataFrame, path: str, mode: str) -> None:
    """Runs a stream over everything available into Parquet files at ``path``.

    In complete mode each batch replaces the table, in append mode a batch that
    is repeated after a failure replaces its own part.
    """

    def sink(batch: DataFrame, number: int) -> None:
        out = path if mode == "complete" else f"{path}/batch={number}"
        batch.write.mode("overwrite").parquet(out)

    q = stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", f"{path}-progress").trigger(availableNow=True).start()
    q.awaitTermination()
