"""Streaming runs bound to the driver tables.

Landing files are written by Spark from the given tables into a run-unique
folder under the shared checkpoint directory, then consumed by the
streaming twins; each query returns a frame over the streamed output.
These callables run jobs (a stream must run to produce rows).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.times import instant_to_ntz, ntz_to_instant
from stratum.operators.ordered import time_chunk
from stratum.session import scratch_path
from stratum.sources.files import RESCUED, Source
from stratum.sources.ingest import ingest_all, read_bronze
from stratum.streaming.ignition import IgnitionTrips
from stratum.streaming.scd2_stream import run_scd2_stream
from stratum.streaming.telemetry_stream import (dedup_stream, run_to_sink, sessions_stream,
                                                split_late, windows_stream)
from stratum.plans.common import t
from stratum.plans.telematics import TRIP_GAP_SECONDS

CUSTOMER_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
NATION_COLUMNS = ("n_nationkey", "n_name", "n_regionkey")
ORDER_FIELDS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                "o_orderpriority")

LATE_DELAY_SECONDS = 10 * 86_400

# Registry: one landed file family per bronze table (SRC2, SRC6, SRC13, SRC16).
SOURCES = (
    Source("raw_customer", "customer", "*.csv", "csv", ",", True, columns=CUSTOMER_COLUMNS, pii=("c_name",)),
    Source("raw_supplier", "supplier", "*.csv", "csv", ";", True, pii=("s_name",)),
    Source("raw_nation", "nation", "*.csv", "csv", "\t", False, columns=NATION_COLUMNS),
    Source("raw_orders", "orders", "*.json", "json"),
    Source("raw_part", "part", "*.txt", "csv"),
    Source("raw_complaints", "complaints", "*.txt", "csv", "\t", False,
           columns=("maketxt", "modeltxt", "yeartxt", "cdescr")),   # not landed: skipped
    Source("raw_broken", "nation", "*.csv", "unknown"),              # can't be read: an error of its own
)


def _stage_landing(spark: SparkSession, sf_dir: str, landing: str) -> None:
    # files of two layouts: as registered, and reordered, renamed and with one column more
    customer = t(spark, sf_dir, "customer").select(*CUSTOMER_COLUMNS)
    customer.where("c_custkey % 2 = 0").write.option("header", True).csv(f"{landing}/customer")
    customer.where("c_custkey % 2 = 1").select(
        "c_mktsegment", F.col("c_acctbal").alias("balance"), "c_name", F.lit("x").alias("extra"), "c_nationkey",
        "c_custkey").write.mode("append").option("header", True).csv(f"{landing}/customer")
    t(spark, sf_dir, "supplier").write.option("header", True).option("sep", ";").csv(f"{landing}/supplier")
    t(spark, sf_dir, "nation").write.option("header", False).option("sep", "\t").csv(f"{landing}/nation")
    t(spark, sf_dir, "orders").write.json(f"{landing}/orders")
    # files as users land them: a byte order mark, a blank first line, line breaks and blank lines in quotes
    part = t(spark, sf_dir, "part")
    line = F.format_string('%s,"%s\n\n""%s""","%s\n",%s', F.col("p_partkey").cast("string"), "p_name", "p_brand",
                           "p_type", F.col("p_size").cast("string"))
    (part.groupBy((F.col("p_partkey") % 8).alias("file")).agg(F.array_join(F.collect_list(line), "\n").alias("body"))
     .select("file", F.concat(F.lit("\ufeff\n  \np_partkey,p_name,p_type,p_size\n"), "body").alias("value"))
     .write.partitionBy("file").text(f"{landing}/part"))


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1-8, SNK1-2: land files, ingest every registry entry twice with
    the same checkpoints; the re-run must add 0 rows."""
    root = scratch_path(spark, "bronze_ingest")
    landing, bronze, ckpt = f"{root}/landing", f"{root}/bronze", f"{root}/_checkpoints"
    _stage_landing(spark, sf_dir, landing)
    first, rerun = str(uuid.uuid4()), str(uuid.uuid4())
    status = ingest_all(spark, SOURCES, landing, bronze, ckpt, {"raw_orders": ORDER_FIELDS}, first)
    ingest_all(spark, SOURCES, landing, bronze, ckpt, {"raw_orders": ORDER_FIELDS}, rerun)
    ok = [r["table"] for r in status.where("status = 'OK'").collect()]   # registry-sized
    bronze_frames = {name: spark.read.parquet(f"{bronze}/{name}") for name in ok}
    tagged = spark.createDataFrame(
        [(name, sum(1 for f in d.schema.fields if ((f.metadata or {}).get("tags") or {}).get("pii")))
         for name, d in bronze_frames.items()], "table string, pii_tagged int")   # schema-sized
    # of a part, the key counts only if its quoted line breaks came through whole
    key_of = {"raw_customer": F.col("c_custkey").try_cast("bigint"),
              "raw_part": F.when(F.col("p_name").rlike(r'(?s)^[^\n"]+\n\n"[^"]+"$') & F.col("p_type").endswith("\n")
                                 & F.col("p_size").rlike("^[0-9]+$"), F.col("p_partkey").try_cast("bigint"))}
    parts = [d.select(F.lit(name).alias("table"), RESCUED, "_batch_id",
                      key_of.get(name, F.lit(None)).cast("bigint").alias("key")) for name, d in bronze_frames.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    counts = u.groupBy("table").agg(F.count(F.lit(1)).alias("rows"),
                                    F.count_if(F.col(RESCUED).isNotNull()).alias("rescued_rows"),
                                    F.count_if(F.col("_batch_id") == rerun).alias("rerun_rows"),
                                    F.sum("key").alias("key_sum"))
    return (status.join(counts, "table", "left").join(tagged, "table", "left")
                  .select("table", "status", "rows", "rescued_rows", "rerun_rows", "key_sum", "pii_tagged"))


def bronze_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK6: a feed whose later files have a column more and one less; the table
    gets the new column, rows from before read NULL there, nothing is rescued."""
    root = scratch_path(spark, "bronze_evolving")
    src = (Source("raw_supplier", "supplier", "*.csv"),)
    supplier = t(spark, sf_dir, "supplier")
    halves = [supplier.where("s_suppkey % 2 = 0").drop("s_acctbal"), supplier.where("s_suppkey % 2 = 1").drop("s_name")]
    for half in halves:
        half.write.mode("append").option("header", True).csv(f"{root}/landing/supplier")
        ingest_all(spark, src, f"{root}/landing", f"{root}/bronze", f"{root}/_checkpoints", evolve=True)
    rows = read_bronze(spark, f"{root}/bronze/raw_supplier")
    return rows.select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "s_name",
                       F.col("s_nationkey").cast("int").alias("s_nationkey"),
                       F.col("s_acctbal").cast("double").alias("s_acctbal"),
                       F.col(RESCUED).isNotNull().alias("rescued"))


def stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming twin of ``scd2_policyholder``: the change log arrives as
    several files (one micro-batch each, years interleaved), merged with
    ``foreachBatch`` into a bucketed snapshot."""
    root = scratch_path(spark, "stream_scd2")
    changes = _policy_changes(spark, sf_dir)
    _land_by_year(changes, f"{root}/landing")
    snap = run_scd2_stream(spark, _year_stream(spark, f"{root}/landing", changes), ["policy_id"],
                           ["seq_ts", "seq_tie"], ["tier"], lambda: time_chunk("seq_ts", "year"),
                           root, buckets=_buckets(spark))
    return snap.select("policy_id", "tier", "effective_from", "effective_to", "is_current", "seq_tie")


def _policy_changes(spark, sf_dir) -> DataFrame:
    return t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("policy_id"), F.col("o_orderpriority").alias("tier"),
        F.col("o_orderdate").alias("seq_ts"), F.col("o_orderkey").alias("seq_tie"))


def _land_by_year(changes: DataFrame, path: str) -> None:
    changes.withColumn("year", F.year("seq_ts")).write.partitionBy("year").parquet(path)


def _year_stream(spark, path: str, changes: DataFrame) -> DataFrame:
    """The landed change log, a few files per micro-batch."""
    schema = changes.withColumn("year", F.year("seq_ts")).schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(path)
            .select(*changes.columns))


def _buckets(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stream_policyholder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR5 + CDC1: two portfolios' change streams united into one history;
    the second delivers part of the first's rows again."""
    root = scratch_path(spark, "stream_policyholder")
    changes = _policy_changes(spark, sf_dir)
    _land_by_year(changes.where("seq_tie % 2 = 0 OR seq_tie % 3 = 0"), f"{root}/landing_a")
    _land_by_year(changes.where("seq_tie % 2 = 1 OR seq_tie % 3 = 0"), f"{root}/landing_b")
    both = _year_stream(spark, f"{root}/landing_a", changes).unionByName(
        _year_stream(spark, f"{root}/landing_b", changes))
    snap = run_scd2_stream(spark, both, ["policy_id"], ["seq_ts", "seq_tie"], ["tier"],
                           lambda: time_chunk("seq_ts", "year"), root, buckets=_buckets(spark))
    return snap.select("policy_id", "tier", "effective_from", "effective_to", "is_current", "seq_tie")


def stream_vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC10 + STR5 + CDC2: the vehicle dimension from a table that is read as
    a stream (``readStream.table``): a version per change of a vehicle's (part's)
    category, here the supplier."""
    root = scratch_path(spark, "stream_vehicle")
    name = "vehicle_changes_" + uuid.uuid4().hex[:12]
    changes = t(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("vehicle_key"), F.col("l_suppkey").alias("category"),
        F.col("l_shipdate").alias("seq_ts"), F.col("l_orderkey").alias("seq_order"),
        F.col("l_linenumber").alias("seq_line"))
    changes.write.format("parquet").option("path", f"{root}/table").saveAsTable(name)
    try:
        snap = run_scd2_stream(spark, spark.readStream.table(name), ["vehicle_key"],
                               ["seq_ts", "seq_order", "seq_line"], ["category"],
                               lambda: time_chunk("seq_ts", "year"), root, buckets=_buckets(spark))
    finally:
        spark.sql(f"DROP TABLE {name}")         # external: the files stay
    return snap.select("vehicle_key", "category", "effective_from", "effective_to", "is_current",
                       "seq_order", "seq_line")


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR9: the newer half of the feed arrives first, the older half after
    it; rows more than 10 days behind are late and kept in a side table."""
    root = scratch_path(spark, "stream_late_rows")
    ev = _events(spark, sf_dir)
    half = F.pmod(F.col("event_id"), F.lit(2)) == 0
    writer = split_late(spark, root, "ts", LATE_DELAY_SECONDS)
    for i, part in enumerate((ev.where(half), ev.where(~half))):
        part.write.parquet(f"{root}/landing/delivery={i}")
        q = (spark.readStream.schema(ev.schema).parquet(f"{root}/landing").select(*ev.columns)
             .writeStream.foreachBatch(writer).option("checkpointLocation", f"{root}/_checkpoint")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    rows = spark.read.parquet(f"{root}/rows")
    return rows.select("event_id", "vehicle_id", instant_to_ntz("ts").alias("ts"),
                       F.col("is_late").cast("boolean").alias("is_late"))


def _events(spark, sf_dir) -> DataFrame:
    e = t(spark, sf_dir, "events")
    # Watermarks need TIMESTAMP (not NTZ): the wall clock is mapped to an
    # instant exactly (as UTC, whatever the session zone) and mapped back
    # on output.
    return e.select(F.col("user_id").alias("vehicle_id"), "event_id",
                    ntz_to_instant("ts").alias("ts"), "event_type", "value",
                    F.lit(False).alias("is_sentinel"))


def _sentinel(spark, sf_dir) -> DataFrame:
    """One row far after the last event: advances the watermark so every
    real session/window is closed and emitted; dropped from the result."""
    e = _events(spark, sf_dir)
    return e.agg(F.max("ts").alias("ts")).select(
        F.lit(-1).cast("long").alias("vehicle_id"), F.lit(-1).cast("long").alias("event_id"),
        (F.col("ts") + F.expr("INTERVAL 60 DAYS")).alias("ts"), F.lit("sentinel").alias("event_type"),
        F.lit(0.0).alias("value"), F.lit(True).alias("is_sentinel"))


def _run_with_sentinel(spark, sf_dir, name, build) -> DataFrame:
    root = scratch_path(spark, name)
    src, out, ck = f"{root}/landing", f"{root}/out", f"{root}/_checkpoint"
    ev = _events(spark, sf_dir)
    ev.write.parquet(f"{src}/part=data")
    stream = build(spark.readStream.schema(ev.schema).parquet(src))
    run_to_sink(stream, out, ck)
    _sentinel(spark, sf_dir).write.parquet(f"{src}/part=sentinel")
    # the sentinel batch moves the watermark; the trailing no-data batch of
    # the same run evicts and emits every closed session / window
    run_to_sink(build(spark.readStream.schema(ev.schema).parquet(src)), out, ck)
    return spark.read.parquet(out).where(~F.col("is_sentinel"))


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR6 streaming twin: must equal the batch trips (fact_trip)."""
    res = _run_with_sentinel(spark, sf_dir, "stream_sessions",
                             lambda s: sessions_stream(s, "vehicle_id", "ts", "6 hours", "6 hours"))
    return res.select("vehicle_id", instant_to_ntz("trip_start").alias("trip_start"),
                      instant_to_ntz("trip_end").alias("trip_end"), "n_events")


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR9: hourly tumbling windows per event type under a watermark."""
    res = _run_with_sentinel(spark, sf_dir, "stream_windows",
                             lambda s: windows_stream(s, "ts", "1 hour", "10 minutes", "event_type", "value"))
    return res.select(instant_to_ntz("w.start").alias("window_start"), "event_type", "n_events",
                      F.round("value_sum", 2).alias("value_sum"))


def stream_sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR9: two-hour windows every 30 minutes per event type."""
    res = _run_with_sentinel(
        spark, sf_dir, "stream_sliding_windows",
        lambda s: windows_stream(s, "ts", "2 hours", "10 minutes", "event_type", "value", "30 minutes"))
    return res.select(instant_to_ntz("w.start").alias("window_start"), "event_type", "n_events",
                      F.round("value_sum", 2).alias("value_sum"))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR4/DED2: the whole feed is delivered twice; watermark dedup on the
    event id restores exactly-once rows."""
    root = scratch_path(spark, "stream_dedup")
    ev = _events(spark, sf_dir)
    ev.write.parquet(f"{root}/landing/copy=1")
    ev.write.parquet(f"{root}/landing/copy=2")
    stream = dedup_stream(spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 4)
                          .parquet(f"{root}/landing"), ["event_id"], "ts", "31 days")
    run_to_sink(stream, f"{root}/out", f"{root}/_checkpoint")
    out = spark.read.parquet(f"{root}/out")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"),
                                         F.count_distinct("event_id").alias("n_distinct"),
                                         F.round(F.sum("value"), 2).alias("value_sum"))


IGNITION_DELAY_SECONDS = 3 * 86_400
DELIVERIES = 4


def _ignition(spark: SparkSession, sf_dir: str, name: str) -> IgnitionTrips:
    """Trips of a feed in four deliveries: a row comes up to three days after
    its time, so each delivery is out of order and reaches back into the one
    before."""
    root = scratch_path(spark, name)
    ev = _events(spark, sf_dir)
    held = F.pmod(F.xxhash64("event_id"), F.lit(IGNITION_DELAY_SECONDS))
    arrival = F.unix_seconds("ts") + held
    span = ev.agg(F.min(arrival).alias("lo"), F.max(arrival).alias("hi")).first()
    step = (span["hi"] - span["lo"]) // DELIVERIES + 1
    trips = IgnitionTrips(spark, root, "signup", "purchase", TRIP_GAP_SECONDS, IGNITION_DELAY_SECONDS,
                          lambda ts: time_chunk(ts, "day"))
    for i in range(DELIVERIES):
        ev.where(F.floor((arrival - span["lo"]) / step) == i).write.parquet(f"{root}/landing/delivery={i}")
        trips.run(spark.readStream.schema(ev.schema).parquet(f"{root}/landing"))
    return trips


def stream_ignition_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR7 streaming twin of ``trips_by_ignition``: four micro-batches with rows
    out of order; open trips and rows before their time are carried over."""
    trips = _ignition(spark, sf_dir, "stream_ignition")
    late = trips.late().withColumns({"is_trip_start": F.lit(None).cast("boolean"),
                                     "trip_start": F.lit(None).cast("timestamp")})
    rows = trips.rows().withColumn("late", F.lit(False)).unionByName(
        late.withColumn("late", F.lit(True)), allowMissingColumns=True)
    return rows.select("event_id", "vehicle_id", instant_to_ntz("ts").alias("ts"), "event_type",
                       "is_trip_start", instant_to_ntz("trip_start").alias("trip_start"), "late")


def stream_trip_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR7 + STR11: the trips that the watermark has closed, and what ended
    them: an ignition-off, the next ignition-on, or the timeout."""
    ended = _ignition(spark, sf_dir, "stream_trip_ends").ended_trips()
    return ended.select("vehicle_id", instant_to_ntz("trip_start").alias("trip_start"),
                        instant_to_ntz("trip_end").alias("trip_end"), "n_events", "ended_by")
