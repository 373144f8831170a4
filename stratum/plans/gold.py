"""Gold layer bound to the driver tables: star schema, point-in-time and
as-of enrichment, interval windows, bridging, exposure and recall joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.keys import surrogate_key
from stratum.operators.lifecycle import OPEN
from stratum.operators.joins import (aggregate_then_join, asof_join, bridge, interval_join,
                                     point_in_time, small_side, star_join)
from stratum.plans import claims, policy, telematics
from stratum.plans.common import t

UNKNOWN_KEY = -1                 # unknown-member key of every dimension
LOSS_LOOKBACK_SECONDS = 30 * 60  # interval window before a loss
ASOF_TOLERANCE_SECONDS = 3600    # as-of reading must be at most this old
RECALL_MIN_SIZE = 45             # binding: parts with p_size > 45 are recalled


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = t(spark, sf_dir, "nation"), t(spark, sf_dir, "region")
    return n.join(small_side(r), n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))


def dim_date(spark, sf_dir):
    """AGG18: calendar over the claim date span (one row per day)."""
    c = claims.claim_valid(spark, sf_dir)
    span = c.agg(F.min("incident_date").alias("lo"), F.max("incident_date").alias("hi"))
    d = span.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return d.select(
        "date", (F.year("date") * 10000 + F.month("date") * 100 + F.dayofmonth("date")).alias("date_key"),
        F.year("date").alias("year"), F.quarter("date").alias("quarter"),
        F.month("date").alias("month"), (F.weekday("date") + 1).alias("iso_dow"),
        (F.weekday("date") >= 5).alias("is_weekend"))


def dim_claim_type(spark, sf_dir):
    """AGG17: static dimension with a content-hash surrogate key."""
    c = claims.claim_valid(spark, sf_dir)
    return (c.where(F.col("claim_type").isNotNull()).select("claim_type").distinct()
             .select(surrogate_key("claim_type").alias("claim_type_key"), "claim_type"))


def dim_claim_status(spark, sf_dir):
    """AGG17: statuses a claim can end in or be in, with whether they are final."""
    c = claims.claim_valid(spark, sf_dir).select("claim_status").distinct()
    return c.select(surrogate_key("claim_status").alias("claim_status_key"), "claim_status",
                    (F.col("claim_status") != OPEN).alias("is_final"))


def dim_geography(spark, sf_dir):
    """AGG17: nations with their region."""
    return geography(spark, sf_dir).select(surrogate_key("nation", "region").alias("geography_key"),
                                           "nation", "region")


def dim_incident(spark, sf_dir):
    """AGG17: the severities that occur with each claim type."""
    c = claims.claim_valid(spark, sf_dir).select("claim_type", "severity").distinct()
    return c.select(surrogate_key("claim_type", "severity").alias("incident_key"), "claim_type", "severity")


def dim_coverage(spark, sf_dir):
    """AGG17: the combinations of covers that claims draw on."""
    drawn = {n: F.coalesce(F.col(f"{n}_claim") > 0, F.lit(False)).alias(n) for n in ("injury", "property", "vehicle")}
    c = claims.claim_valid(spark, sf_dir).select(*drawn.values()).distinct()
    return c.select(surrogate_key(*drawn).alias("coverage_key"), *drawn)


def star(spark, sf_dir, claim=None):
    """AGG6 + JN1: claim-grain fact with its dimension keys (unknown = -1),
    the four amounts, and the attributes that marts group by."""
    fact = (claim or claims.claim_valid(spark, sf_dir)).withColumn(
        "policy_key", F.when(F.col("source_system") == "orders", F.col("policy_number").try_cast("bigint")))
    cust = t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("policy_key"), "c_nationkey", "c_mktsegment")
    geo = geography(spark, sf_dir).withColumnRenamed("n_nationkey", "c_nationkey")
    j = star_join(fact, [(cust, ["policy_key"]), (geo, ["c_nationkey"])])
    return j.select(
        "claim_id", "source_system",
        F.coalesce(F.when(F.col("c_nationkey").isNotNull(), F.col("policy_key")),
                   F.lit(UNKNOWN_KEY)).cast("bigint").alias("policy_key"),
        F.coalesce("c_mktsegment", F.lit("UNKNOWN")).alias("segment"),
        F.coalesce("nation", F.lit("UNKNOWN")).alias("nation"),
        F.coalesce("region", F.lit("UNKNOWN")).alias("region"),
        F.coalesce(F.year("incident_date") * 10000 + F.month("incident_date") * 100 + F.dayofmonth("incident_date"),
                   F.lit(UNKNOWN_KEY)).alias("date_key"),
        F.when(F.col("claim_type").isNull(), F.lit(str(UNKNOWN_KEY)))
        .otherwise(surrogate_key("claim_type")).alias("claim_type_key"),
        F.col("total_claim_amount").cast("double").alias("claim_amount"),
        *[F.col(f"{n}_claim").cast("double").alias(f"{n}_amount") for n in ("injury", "property", "vehicle")],
        F.col("fraud").cast("int").alias("is_fraud"),
        F.lit(1).alias("claim_count"),
        "claim_type", "severity", "auto_make", "vehicle_category", "settlement_date")


def star_claims(spark, sf_dir):
    """The fact as published: keys and measures."""
    return star(spark, sf_dir).drop("claim_type", "severity", "auto_make", "vehicle_category", "settlement_date")


def point_in_time_policy(spark, sf_dir):
    """JN2: each claim line gets the policyholder tier valid on its ship date."""
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                          F.col("o_custkey").alias("policy_id"))
    fact = li.join(o, "l_orderkey")
    dim = policy.scd2_policyholder(spark, sf_dir)
    return point_in_time(fact, dim, ["policy_id"], "l_shipdate", ["tier"], tie="seq_tie")


def _losses_and_readings(spark, sf_dir):
    tel = telematics.telemetry(spark, sf_dir)
    losses = tel.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("loss_id"), "vehicle_id", F.col("ts").alias("loss_ts"))
    readings = tel.where(F.col("event_type") != "error").select(
        "event_id", "vehicle_id", "ts", "speed")
    return losses, readings


def asof_telemetry(spark, sf_dir):
    """JN4: latest telemetry reading at or before each loss (<= 1 h old)."""
    losses, readings = _losses_and_readings(spark, sf_dir)
    return asof_join(losses, readings, ["vehicle_id"], "loss_ts", "ts", ["event_id", "speed"],
                     right_tie="event_id", tolerance_seconds=ASOF_TOLERANCE_SECONDS)


def interval_telemetry(spark, sf_dir):
    """JN4 (interval form): readings in the 30 minutes up to each loss."""
    losses, readings = _losses_and_readings(spark, sf_dir)
    pairs = interval_join(losses, readings, ["vehicle_id"], "loss_ts", "ts", LOSS_LOOKBACK_SECONDS)
    per = pairs.groupBy("loss_id").agg(F.count(F.lit(1)).alias("n_readings"),
                                       F.max("speed").alias("max_speed"),
                                       F.round(F.avg("speed"), 4).alias("avg_speed"))
    return losses.join(per, "loss_id", "left").select(
        "loss_id", "vehicle_id", "loss_ts", F.coalesce("n_readings", F.lit(0)).alias("n_readings"),
        "max_speed", "avg_speed")


def bridge_keys(spark, sf_dir):
    """JN7: seeded policy-holder -> vehicle mapping across unlinked sources."""
    cust = t(spark, sf_dir, "customer")
    users = t(spark, sf_dir, "events").select(F.col("user_id").alias("vehicle_id"))
    return bridge(cust, "c_custkey", users, "vehicle_id")


def _claims_b(spark, sf_dir):
    c = claims.claim_valid(spark, sf_dir)
    return c.where(F.col("source_system") == "lineitem").select(
        F.col("policy_number").try_cast("bigint").alias("order_key"), "fraud")


def policy_claims(spark, sf_dir):
    """JN6: one row per policy term with its claims aggregated first."""
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), "o_custkey")
    j = aggregate_then_join(o, _claims_b(spark, sf_dir), "order_key", "order_key",
                            [F.count(F.lit(1)).alias("n_claims"),
                             F.count_if(F.col("fraud")).alias("n_fraud")])
    return j.select("order_key", "o_custkey", F.coalesce("n_claims", F.lit(0)).alias("n_claims"),
                    F.coalesce("n_fraud", F.lit(0)).alias("n_fraud"))


def claim_frequency(spark, sf_dir):
    """JN8: claims per exposure year per policyholder (term = 1 year)."""
    terms = policy_claims(spark, sf_dir)
    per = terms.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("exposure_years"), F.sum("n_claims").alias("n_claims"))
    cust = t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = cust.join(per, "c_custkey", "left")
    return j.select("c_custkey", "c_mktsegment",
                    F.coalesce("exposure_years", F.lit(0)).alias("exposure_years"),
                    F.coalesce("n_claims", F.lit(0)).alias("n_claims"),
                    F.round(F.col("n_claims") / F.col("exposure_years"), 6).alias("claim_frequency"))


def recall_match(spark, sf_dir):
    """JN9: claim lines on vehicles (parts) under a recall campaign."""
    part = t(spark, sf_dir, "part")
    campaigns = (part.where(F.col("p_size") > RECALL_MIN_SIZE)
                     .select("p_brand", "p_type").distinct()
                     .withColumn("campaign_id", surrogate_key("p_brand", "p_type")))
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    hit = li.join(parts, "l_partkey").join(small_side(campaigns), ["p_brand", "p_type"])
    return hit.groupBy("campaign_id", "p_brand", "p_type").agg(
        F.count(F.lit(1)).alias("n_claim_lines"),
        F.count_distinct("l_orderkey").alias("n_orders"),
        F.count_distinct("l_partkey").alias("n_parts"))
