"""Streaming resilience and reconciliation properties."""

import tempfile

import pytest
from pyspark.sql import functions as F

from stratum.operators.cdc import scd2
from stratum.operators.ordered import time_chunk
from stratum.streaming.scd2_stream import Scd2Snapshot

from conftest import SF_SMALL


def _changes(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    return o.select(F.col("o_custkey").alias("policy_id"), F.col("o_orderpriority").alias("tier"),
                    F.col("o_orderdate").alias("seq_ts"), F.col("o_orderkey").alias("seq_tie"))


def test_scd2_stream_survives_a_failed_batch(spark):
    root = tempfile.mkdtemp(prefix="stratum-scd2-fail-")
    ch = _changes(spark)
    ch.repartition(5, F.year("seq_ts")).write.parquet(f"{root}/landing")
    snapshot = Scd2Snapshot(spark, f"{root}/snap", ["policy_id"], ["seq_ts", "seq_tie"], ["tier"],
                            lambda: time_chunk("seq_ts", "year"), 8)
    writer = snapshot.write_batch
    state = {"failed": False}

    def flaky(batch, batch_id):
        writer(batch, batch_id)
        if batch_id == 2 and not state["failed"]:
            state["failed"] = True       # the batch's output is written, the commit is not
            raise RuntimeError("simulated executor loss")

    def run(fn):
        q = (spark.readStream.schema(ch.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landing")
             .writeStream.foreachBatch(fn).option("checkpointLocation", f"{root}/ck")
             .trigger(availableNow=True).start())
        q.awaitTermination()

    with pytest.raises(Exception):
        run(flaky)
    run(writer)                          # restart: batch 2 is replayed
    got = snapshot.read()
    want = scd2(ch, ["policy_id"], ["seq_ts", "seq_tie"], ["tier"], time_chunk("seq_ts", "year"),
                coalesce_repeats=False)
    cols = sorted(want.columns)
    assert sorted(got.select(cols).collect(), key=repr) == sorted(want.select(cols).collect(), key=repr)


def test_kpi_reconciles_to_fact(spark):
    import __spark_entry__ as entry
    q = entry.queries()
    kpi = q["mart_claims_kpi"](spark, SF_SMALL).agg(F.sum("n_claims"), F.sum("incurred")).first()
    fact = q["claim_valid"](spark, SF_SMALL).agg(F.count("*"), F.sum("total_claim_amount")).first()
    assert kpi[0] == fact[0]
    assert abs(kpi[1] - fact[1]) < 1e-6 * max(1.0, abs(fact[1]))


def test_observed_expectations_on_a_stream(spark):
    from stratum.operators.quality import observe_expectations
    root = tempfile.mkdtemp(prefix="stratum-observe-")
    df = spark.createDataFrame([(1, 10.0), (2, -1.0), (3, None)], "id int, speed double")
    df.write.parquet(f"{root}/in")
    src = observe_expectations(spark.readStream.schema(df.schema).parquet(f"{root}/in"), "dq",
                               {"speed_ok": "speed >= 0"})
    q = (src.writeStream.format("noop").option("checkpointLocation", f"{root}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    metrics = [p["observedMetrics"]["dq"] for p in q.recentProgress if p.get("observedMetrics")]
    assert metrics and metrics[-1]["rows"] == 3 and metrics[-1]["speed_ok_failed"] == 2


def test_late_rows_are_counted(spark):
    import datetime as dt

    from stratum.streaming.telemetry_stream import late_rows, run_to_sink, windows_stream
    root = tempfile.mkdtemp(prefix="stratum-late-")
    t0 = dt.datetime(2024, 1, 1)
    schema = "ts timestamp, event_type string, value double, is_sentinel boolean"
    spark.createDataFrame([(t0 + dt.timedelta(minutes=m), "a", 1.0, False) for m in range(0, 120, 10)],
                          schema).write.parquet(f"{root}/in/p=1")

    def build():
        return windows_stream(spark.readStream.schema(schema).parquet(f"{root}/in"),
                              "ts", "1 hour", "10 minutes", "event_type", "value")

    run_to_sink(build(), f"{root}/out", f"{root}/ck")
    # a re-delivery of rows in three hours older than the watermark arrives
    # later (one row per window: the count is per window and key)
    spark.createDataFrame([(t0 - dt.timedelta(hours=h), "a", 5.0, False) for h in (2, 3, 4)], schema) \
        .write.parquet(f"{root}/in/p=2")
    q = run_to_sink(build(), f"{root}/out", f"{root}/ck")
    assert late_rows(q) == 3


def test_state_partitions_follow_the_cluster_and_conf_is_restored(spark):
    import datetime as dt

    from stratum.streaming.telemetry_stream import run_to_sink, windows_stream
    root = tempfile.mkdtemp(prefix="stratum-statepart-")
    schema = "ts timestamp, event_type string, value double, is_sentinel boolean"
    spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, m), "a", 1.0, False) for m in range(5)], schema) \
        .write.parquet(f"{root}/in")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    q = run_to_sink(windows_stream(spark.readStream.schema(schema).parquet(f"{root}/in"),
                                   "ts", "1 hour", "10 minutes", "event_type", "value"),
                    f"{root}/out", f"{root}/ck", state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    ops = [op for p in q.recentProgress for op in (p.get("stateOperators") or [])]
    assert ops and all(op.get("numShufflePartitions", 3) == 3 for op in ops)


def test_late_rows_go_to_the_side_table_and_a_replay_changes_nothing(spark):
    from stratum.streaming.telemetry_stream import split_late
    root = tempfile.mkdtemp(prefix="stratum-late-")
    write = split_late(spark, root, "ts", 60)

    def batch(*seconds):
        return spark.createDataFrame([(s,) for s in seconds], "s long").selectExpr("s", "timestamp_seconds(s) AS ts")
    write(batch(1000, 5), 0)
    write(batch(939, 940, 2000), 1)
    write(batch(939, 940, 2000), 1)
    write(batch(1500, 1940), 2)
    got = {(r.s, str(r.is_late).lower()) for r in spark.read.parquet(f"{root}/rows").collect()}
    assert got == {(1000, "false"), (5, "false"), (939, "true"), (940, "false"), (2000, "false"),
                   (1500, "true"), (1940, "false")}
    assert spark.read.parquet(f"{root}/rows").count() == 7


def test_merge_table(spark):
    from stratum.sinks import MergeTable
    table = MergeTable(spark, tempfile.mkdtemp(prefix="stratum-merge-"), ["k"], ["seq"])
    rows = lambda *r: spark.createDataFrame(r, "k long, seq long, v string")
    assert table.read() is None
    table.merge(rows((1, 1, "a"), (2, 5, "b")))
    table.merge(rows((1, 2, "c"), (2, 4, "old"), (3, 1, "n")))
    want = {(1, 2, "c"), (2, 5, "b"), (3, 1, "n")}
    assert {tuple(r) for r in table.read().collect()} == want
    assert {tuple(r) for r in table.merge(rows((1, 2, "c"))).collect()} == want
