"""Streaming telemetry: session windows, watermark dedup and tumbling
windows with late-data accounting (STR4, STR6, STR9, STR11).

State is bounded by the watermark in every query: sessions and windows are
evicted once the watermark passes them, dedup keys once older than the
delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.sources.files import read_text_file, write_text_file


def sessions_stream(events: DataFrame, key: str, ts: str, gap: str, delay: str) -> DataFrame:
    """Gap-based trips: ``session_window`` (merges when next <= prev + gap),
    append mode emits a trip once the watermark passes its end."""
    return (events.withWatermark(ts, delay)
                  .groupBy(key, F.session_window(ts, gap).alias("w"))
                  .agg(F.min(ts).alias("trip_start"), F.max(ts).alias("trip_end"),
                       F.count(F.lit(1)).alias("n_events"),
                       F.max("is_sentinel").alias("is_sentinel")))


def dedup_stream(events: DataFrame, keys, ts: str, delay: str) -> DataFrame:
    """At-least-once delivery -> exactly-once rows: duplicates of ``keys``
    arriving within ``delay`` of each other are dropped; state expires with
    the watermark."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def windows_stream(events: DataFrame, ts: str, size: str, delay: str, by: str,
                   value: str, slide: str | None = None) -> DataFrame:
    """Event-time windows per ``by`` with a watermark: tumbling, or sliding by
    ``slide``."""
    return (events.withWatermark(ts, delay)
                  .groupBy(F.window(ts, size, slide).alias("w"), by)
                  .agg(F.count(F.lit(1)).alias("n_events"),
                       F.sum(value).alias("value_sum"),
                       F.max("is_sentinel").alias("is_sentinel")))


def split_late(spark: SparkSession, root: str, ts: str, delay_seconds: int):
    """A ``foreachBatch`` writer that keeps late rows: each micro-batch is
    written once, partitioned by ``is_late``, to ``root/rows``.  A row is late
    if its time is before the greatest time of the earlier micro-batches less
    the delay.  That time is kept in a control file per micro-batch, so a
    replayed batch decides as before and overwrites its own folder."""
    def write(batch: DataFrame, number: int) -> None:
        before = read_text_file(spark, f"{root}/seen/{number - 1}") if number else None
        seen = int(before) if before else None
        micros = F.unix_micros(F.col(ts))
        late = F.lit(False) if seen is None else F.coalesce(micros < seen - delay_seconds * 1_000_000, F.lit(False))
        path = f"{root}/rows/batch_id={number}"
        batch.withColumn("is_late", late).write.mode("overwrite").partitionBy("is_late").parquet(path)
        top = batch.agg(F.max(micros)).first()[0]
        known = [x for x in (seen, top) if x is not None]
        write_text_file(spark, f"{root}/seen/{number}", str(max(known)) if known else "")
    return write


def trigger_of(processing_time: str | None) -> dict:
    """``availableNow`` (catch up and stop), or a continuous processing time."""
    return {"processingTime": processing_time} if processing_time else {"availableNow": True}


def run_to_sink(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                state_partitions: int | None = None, processing_time: str | None = None):
    """Write a streaming frame to a parquet sink.  By default it is driven to
    completion and the finished query returned (its progress carries the
    late-row counts); with ``processing_time`` the running query is returned.

    Stateful queries fix their number of state partitions when they first
    start (from ``spark.sql.shuffle.partitions``, recorded in the
    checkpoint).  It is sized here to the cluster's task slots (or
    ``state_partitions``) for the start only; ``start()`` copies the session
    configuration, and the setting is restored right after."""
    spark = df.sparkSession
    n = state_partitions or spark.sparkContext.defaultParallelism
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        q = (df.writeStream.format("parquet").outputMode(mode)
               .option("checkpointLocation", checkpoint).trigger(**trigger_of(processing_time)).start(path))
    finally:
        spark.conf.set(key, old)
    if not processing_time:
        q.awaitTermination()
    return q


def late_rows(query) -> int:
    """Rows the stateful operators dropped as later than the watermark,
    summed over the query's recent progress (late-data accounting).  Spark
    counts at the state store, i.e. after map-side partial aggregation: late
    input rows of one (window, key) count once."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) or []:
            total += int(op.get("numRowsDroppedByWatermark", 0) or 0)
    return total
