"""Physical-plan properties that the scale design relies on."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from stratum.operators.dedup import dedup_first
from stratum.operators.joins import left_join_nonnull
from stratum.operators.ordered import neighbour
from stratum.operators.retrieval import top_k_similar

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_partitioned_with_its_chunk(spark):
    df = spark.range(30000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("ts"))
    out = neighbour(df, ["k"], ["ts"], F.floor(F.col("ts") / 1000), ["ts"], "prev")
    plan = _plan(out)
    assert re.search(r"hashpartitioning\(__group#\d+", plan), plan
    # the only exchange on the bare key is over the per-chunk aggregate
    for m in re.finditer(r"Exchange hashpartitioning\(__group#\d+\.k, \d+\)", plan):
        assert "Aggregate" in plan[m.end():m.end() + 400]


def test_dedup_combines_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = _plan(dedup_first(df, ["k"], ["v"]))
    assert re.search(r"Exchange hashpartitioning\(k#\d+L?, \d+\).*\n.*partial_min", plan), plan


def test_top_k_limits_per_task_before_the_shuffle(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    q = e.groupBy("label").agg(F.first("embedding").alias("embedding"))
    plan = _plan(top_k_similar(e, "vec_id", "embedding", q, "label", "embedding", 3))
    assert re.search(r"Exchange hashpartitioning\(label#\d+, \d+\).*\n\s*\+- WindowGroupLimit", plan), plan


def test_filters_reach_the_scan(spark):
    plan = _plan(entry.queries()["upsert_latest"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double" in plan


def test_null_keys_are_dealt_out_in_the_star_join(spark):
    # source-B claims have no policy key: a salt of theirs joins the key, and
    # the fact is neither split nor read twice for them
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"))
        dim = spark.range(0, 1000, 20).select(F.col("id").alias("k"), F.lit("x").alias("name"))
        out = left_join_nonnull(fact, dim, ["k"], max_bytes=0)
        plan = _plan(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Union" not in plan
    assert re.search(r"hashpartitioning\(k#\d+L?, __salt#\d+L?", plan), plan
    assert out.count() == 1000 and out.where("name IS NOT NULL").count() == 50
