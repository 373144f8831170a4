"""What claims carry through shuffles and written frames."""

import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from stratum.plans import extra, features
from stratum.sinks import materialize_keyed
from conftest import SF_SMALL


def test_ordered_lookups_of_the_claim_mart_shuffle_no_claim_frame(spark, monkeypatch):
    seen = []

    def spy(real):
        def call(left, *args, **kwargs):
            seen.append(set(left.columns))
            return real(left, *args, **kwargs)
        return call

    for name in ("asof_join", "point_in_time"):
        monkeypatch.setattr(extra, name, spy(getattr(extra, name)))
    extra.mart_claim_360(spark, SF_SMALL)
    assert len(seen) == 3 and not any(c & {"claim_id", "claim_amount", "segment", "source_system"} for c in seen)


def test_a_reading_without_a_time_is_a_reading(spark, tmp_path):
    for name in ("orders", "lineitem", "customer", "nation", "region", "events"):
        rows = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        if name == "events":
            rows = rows.withColumn("ts", F.when(F.col("event_id") % 4 > 0, F.col("ts")))
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    got = extra.mart_claim_360(spark, str(tmp_path)).where("at_loss_ts IS NULL AND at_loss_event_id IS NOT NULL")
    assert got.count() > 0


def test_keys_are_written_in_binary(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "x string").select(
        F.when(F.col("x").isNotNull(), F.sha2("x", 256)).alias("id"), "x")
    out = materialize_keyed(rows, "keyed", "id")
    assert sorted(map(str, out.collect())) == sorted(map(str, rows.collect())) and out.columns == ["id", "x"]
    files = [f.removeprefix("file://") for f in out.inputFiles()]
    assert files and all(str(pq.read_schema(f).field("id").type) == "binary" for f in files)


def test_evidence_is_joined_to_the_query_claims_only(spark, monkeypatch):
    near = spark.createDataFrame([("a", 1, "b", 1.0, "open", 1.0, True)], "query_id string, rank int, claim_id string, "
                                 "score double, claim_status string, amount double, fraud boolean")
    monkeypatch.setattr(features, "similar_claims", lambda *_: near)
    plan = features.claim_evidence(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"pmod\(.*, 100\) = 0", plan)
