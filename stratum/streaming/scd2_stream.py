"""Streaming SCD2 by local repair (SNK4, CDC1 streaming).

The snapshot is a ``MergeTable`` with a row for each version (key, tracked
attributes, sequence) and the time at which it ends.  A micro-batch touches
little of it:

1. the batch's distinct changes are written once;
2. of the buckets of their keys, only versions are taken up that lie between a
   key's first and last new change, with the one before them; of those after the
   last change the first one's time is enough, an aggregate;
3. these and the new changes are put in order, and each ends where the next
   begins;
4. new versions, and those whose end has changed, are merged.

So what is sorted and written follows the batch, not the history of its keys,
and no change log is kept: every change is a version.  Changes may come in any
order; a change that is there already (a replay, or a feed that delivers twice)
changes nothing; a merge is committed as a whole, so a batch that fails leaves
the snapshot as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.ordered import neighbour
from stratum.session import scratch_path
from stratum.sinks import MergeTable
from stratum.sources.files import folder_bytes
from stratum.streaming.telemetry_stream import trigger_of

# written size up to which a batch's keys are broadcast: they pass through the driver in
# every batch, so larger ones meet the touched buckets in a shuffle
BROADCAST_BYTES = 1 << 20


class Scd2Snapshot:
    """Type-2 versions under ``root``; ``seq`` is a total order within a key, its
    first column the time from which a version holds.  ``buckets`` should be
    about the snapshot's bytes / 1 GB."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], seq: Sequence[str],
                 tracked: Sequence[str], chunk: Callable[[], Column], buckets: int | None = None):
        self.spark, self.keys, self.seq, self.tracked = spark, list(keys), list(seq), list(tracked)
        self.chunk = chunk
        self.table = MergeTable(spark, root, self.keys + self.seq + self.tracked, bucket_by=self.keys,
                                buckets=buckets, broadcast_bytes=BROADCAST_BYTES)

    def write_batch(self, batch: DataFrame, batch_id: int | None = None) -> None:
        """Merge one batch of changes (for ``foreachBatch``)."""
        path = scratch_path(self.spark, "scd2_batch")
        cols = self.keys + self.tracked + self.seq
        batch.select(*cols).distinct().write.parquet(path)
        changes = self.spark.read.parquet(path)
        if changes.isEmpty():
            return
        stored = self.table.buckets_of(changes)
        self.table.merge(self._repaired(changes, stored, folder_bytes(self.spark, path) <= BROADCAST_BYTES))

    def _repaired(self, changes: DataFrame, stored: DataFrame | None, small: bool) -> DataFrame:
        """The new versions, and the stored ones whose end changes."""
        cols, start = self.keys + self.tracked + self.seq, self.seq[0]
        place, key = F.struct(*self.seq), F.struct(*self.keys).alias("__k")
        rows = changes.select(*cols, F.lit(None).cast(changes.schema[start].dataType).alias("__to"),
                              F.lit(False).alias("__stored"))
        if stored is None:
            after = None
        else:
            span = changes.groupBy(*self.keys).agg(F.min(place).alias("__lo"), F.max(place).alias("__hi"))
            span = span.select(key, "__lo", "__hi")
            near = stored.withColumn("__k", F.struct(*self.keys)).join(
                F.broadcast(span) if small else span.hint("merge"), "__k")
            # whole rows, so both uses of ``near`` read one shuffle of the stored versions
            row = F.struct(*self.seq, *self.keys, *self.tracked, "effective_to")
            after = (near.where(place > F.col("__hi")).groupBy(*self.keys).agg(F.min(row).alias("__next"))
                     .select(key, F.col(f"__next.{start}").alias("__after")))
            within = near.where((place <= F.col("__hi")) & (F.col("effective_to").isNull()
                                                            | (F.col("effective_to") >= F.col(f"__lo.{start}"))))
            rows = rows.unionByName(within.select(*cols, F.col("effective_to").alias("__to"),
                                                  F.lit(True).alias("__stored")))
        # a change that is stored already is one row with it
        rows = rows.groupBy(*cols).agg(F.max("__to").alias("__to"), F.max("__stored").alias("__stored"))
        ended = neighbour(rows, self.keys, self.seq, self.chunk(), [start], "next", "__n_")
        end = F.col(f"__n_{start}")
        if after is not None:
            ended = ended.withColumn("__k", F.struct(*self.keys)).join(after.hint("merge"), "__k", "left")
            end = F.coalesce(end, F.col("__after"))
        return (ended.withColumn("effective_to", end)
                .where(~F.col("__stored") | ~F.col("__to").eqNullSafe(F.col("effective_to")))
                .select(*cols, "effective_to"))

    def read(self) -> DataFrame | None:
        rows = self.table.read()
        if rows is None:
            return None
        return rows.select(*self.keys, *self.tracked, F.col(self.seq[0]).alias("effective_from"), "effective_to",
                           F.col("effective_to").isNull().alias("is_current"), *self.seq[1:])


def run_scd2_stream(spark: SparkSession, changes: DataFrame, keys, seq, tracked, chunk_fn,
                    root: str, buckets: int, processing_time: str | None = None) -> DataFrame:
    """Merge the streaming frame ``changes`` into a snapshot; by default to
    completion (``availableNow``).  Feeds are united before: rows delivered
    twice (equal key, attributes and sequence) count once, however far apart
    they arrive."""
    snapshot = Scd2Snapshot(spark, f"{root}/snapshot", keys, seq, tracked, chunk_fn, buckets)
    q = (changes.writeStream.foreachBatch(snapshot.write_batch).option("checkpointLocation", f"{root}/_checkpoint")
         .trigger(**trigger_of(processing_time)).start())
    q.awaitTermination()
    snapshot.table.vacuum()
    return snapshot.read()
