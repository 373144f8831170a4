"""Streaming ignition-based trips (STR7) without a state task per vehicle.

A row starts a trip if it is the vehicle's first row, the row before was an
ignition-off, the gap to it exceeds the timeout (a lost "off"), or it is an
ignition-on: the rule of the batch ``sessionize``, by which each micro-batch is
scanned over (vehicle, time chunk), so one vehicle with a third of all rows is
dealt over its chunks.  Between micro-batches three things are kept in the
shared folder:

- the watermark: the greatest time seen less ``delay_seconds``;
- the pending rows after the watermark.  A row is placed only when the
  watermark has passed it, so rows that come out of order, by up to the delay,
  get their trip.  Rows behind the watermark when they arrive are late; they go
  to a side table (``late``), as do rows without a time;
- the carry: a row for each vehicle with an open trip (its last event, start
  and number of rows).  It leads the vehicle's rows in the next scan.  A trip
  that ended with an "off", or whose timeout the watermark has passed, leaves
  the carry, whose size is that of the open trips.

``rows`` holds every placed row with its trip, ``trips`` a row for each trip
and micro-batch in which it was seen, with ``ended_by`` ("off", "on",
"timeout") once it has ended.  A micro-batch reads what the one before left and
overwrites its own folders, so running it again after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.times import micros_between
from stratum.operators.ordered import neighbour
from stratum.operators.sessions import sessionize
from stratum.sources.files import delete_path, list_names, read_text_file, write_text_file
from stratum.streaming.telemetry_stream import trigger_of

EVENT = ["vehicle_id", "event_id", "ts", "event_type"]


@dataclass(frozen=True)
class IgnitionTrips:
    """The trips of one feed, kept under ``root``.  Events have ``vehicle_id,
    event_id, ts, event_type``; ``chunk`` gives the time chunk of a time."""

    spark: SparkSession
    root: str
    on: str
    off: str
    timeout_seconds: int
    delay_seconds: int
    chunk: Callable[[Column], Column]

    # -- what is kept
    def _seen(self) -> list[int]:
        """Completed micro-batches whose state is still there."""
        return sorted(int(n) for n in list_names(self.spark, f"{self.root}/state") if n.isdigit()
                      and read_text_file(self.spark, f"{self.root}/state/{n}/watermark"))

    def _watermark(self, number: int) -> int | None:
        text = read_text_file(self.spark, f"{self.root}/state/{number}/watermark")
        return None if text in (None, "", "none") else int(text)

    def _folder(self, what: str, number: int) -> str:
        return f"{self.root}/{what}/batch_id={number}"

    def _state(self, number: int | None) -> tuple[DataFrame | None, DataFrame | None, int | None]:
        """Pending rows, carry and watermark that micro-batch ``number`` left."""
        if number is None:
            return None, None, None
        pending = self.spark.read.parquet(f"{self.root}/state/{number}/pending")
        carry = self.spark.read.parquet(self._folder("trips", number)).where("ended_by IS NULL")
        return pending, carry, self._watermark(number)

    # -- one scan
    def _placed(self, ready: DataFrame, carry: DataFrame | None) -> DataFrame:
        """``ready`` and the carry's rows (``n`` = the rows they stand for)."""
        rows = ready.select(*EVENT, F.lit(1).cast("bigint").alias("n"), F.lit(False).alias("is_carry"),
                            F.lit(None).cast(ready.schema["ts"].dataType).alias("known"))
        if carry is not None:
            rows = rows.unionByName(carry.select(
                "vehicle_id", F.col("last_id").alias("event_id"), F.col("trip_end").alias("ts"),
                F.col("last_type").alias("event_type"), F.col("n_events").alias("n"), F.lit(True).alias("is_carry"),
                F.col("trip_start").alias("known")))
        return sessionize(rows, ["vehicle_id"], "ts", "event_id", self.chunk(F.col("ts")),
                          gap_seconds=self.timeout_seconds, start_when=F.col("event_type") == self.on,
                          end_when=F.col("event_type") == self.off, known=F.col("known")).drop("known")

    def _trips(self, placed: DataFrame, watermark: int | None) -> DataFrame:
        """A row for each trip of ``placed``, with what ended it."""
        per = placed.groupBy("vehicle_id", "trip_start").agg(
            F.max(F.struct("ts", "event_id", "event_type")).alias("last"), F.sum("n").alias("n_events"))
        per = per.select("vehicle_id", "trip_start", F.col("last.ts").alias("trip_end"),
                         F.col("last.event_id").alias("last_id"), F.col("last.event_type").alias("last_type"),
                         "n_events")
        after = neighbour(per, ["vehicle_id"], ["trip_start"], self.chunk(F.col("trip_start")), ["trip_start"], "next")
        limit = self.timeout_seconds * 1_000_000
        expired = F.lit(watermark).cast("bigint") - F.unix_micros(F.col("trip_end").cast("timestamp")) > limit
        next_start = F.col("next_trip_start")
        return after.withColumn("ended_by", F.when(F.col("last_type") == self.off, "off")
                                .when(micros_between(F.col("trip_end"), next_start) > limit, "timeout")
                                .when(next_start.isNotNull(), "on")
                                .when(expired, "timeout")).drop("next_trip_start")

    def write_batch(self, batch: DataFrame, number: int) -> None:
        """Place one micro-batch (for ``foreachBatch``)."""
        inbox = f"{self.root}/state/{number}/inbox"
        batch.select(*EVENT).write.mode("overwrite").parquet(inbox)
        arrived = self.spark.read.parquet(inbox)
        pending, carry, before = self._state(number - 1 if number else None)
        micros = F.unix_micros(F.col("ts").cast("timestamp"))
        top = arrived.agg(F.max(micros)).first()[0]
        known = [x for x in (before, None if top is None else top - self.delay_seconds * 1_000_000) if x is not None]
        watermark = max(known) if known else None
        late = F.col("ts").isNull() | (F.lit(False) if before is None else micros <= before)
        arrived.where(late).write.mode("overwrite").parquet(self._folder("late", number))
        rows = arrived.where(~late)
        if pending is not None:
            rows = rows.unionByName(pending)
        due = F.lit(False) if watermark is None else micros <= watermark
        rows.where(~due).write.mode("overwrite").parquet(f"{self.root}/state/{number}/pending")
        self._placed(rows.where(due), carry).write.mode("overwrite").parquet(self._folder("rows", number))
        self._trips(self.spark.read.parquet(self._folder("rows", number)), watermark) \
            .write.mode("overwrite").parquet(self._folder("trips", number))
        write_text_file(self.spark, f"{self.root}/state/{number}/watermark",
                        "none" if watermark is None else str(watermark))
        if number > 1:                  # the one before may be needed again, those before it not
            delete_path(self.spark, f"{self.root}/state/{number - 2}")

    def run(self, events: DataFrame, processing_time: str | None = None):
        """Drive the stream ``events``, by default until it has caught up."""
        query = (events.writeStream.foreachBatch(self.write_batch)
                 .option("checkpointLocation", f"{self.root}/_checkpoint").trigger(**trigger_of(processing_time)).start())
        if not processing_time:
            query.awaitTermination()
        return query

    # -- reading
    def rows(self) -> DataFrame:
        """All rows that aren't late, with their trips: final ones, and pending
        ones (``is_final`` false) as they would be placed if nothing else came."""
        number = max(self._seen())
        pending, carry, _ = self._state(number)
        final = self.spark.read.parquet(f"{self.root}/rows").where("batch_id <= %d" % number)
        out = [*EVENT, "is_trip_start", "trip_start"]
        return (final.where("NOT is_carry").select(*out, F.lit(True).alias("is_final")).unionByName(
            self._placed(pending, carry).where("NOT is_carry").select(*out, F.lit(False).alias("is_final"))))

    def ended_trips(self) -> DataFrame:
        """The trips that have ended, a row each."""
        return (self.spark.read.parquet(f"{self.root}/trips").where("batch_id <= %d" % max(self._seen()))
                .where("ended_by IS NOT NULL").drop("batch_id", "last_id", "last_type"))

    def late(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/late").drop("batch_id")
