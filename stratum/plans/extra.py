"""More bindings: complaints, claim 360, claim-status CDC, conditions at
loss, whole-schema counts, ARFF severity feed, priority ranking, telemetry
fact, streaming quarantine split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions.geo import grid_cell
from stratum.functions.keys import portable_seed
from stratum.functions.money import AMOUNT, to_amount
from stratum.operators.cdc import scd2
from stratum.operators.conform import conform, union_conformed
from stratum.operators.joins import asof_join, bridge, point_in_time, small_side, star_join
from stratum.operators.ordered import time_chunk
from stratum.operators.quality import (apply_rules, observe_expectations, resolve_targets,
                                       severity_reconciliation, validate_counts)
from stratum.operators.retrieval import clean_text
from stratum.plans import claims, gold, policy, telematics
from stratum.plans.common import t
from stratum.plans.insurance import SEVERITY
from stratum.session import scratch_path
from stratum.sinks import materialize
from stratum.sources.files import list_tables, scan_arff, write_arff
from stratum.sources.tables import read_table

# Binding choices: keyword flags for complaint narratives (lower-case).
CRASH_WORDS = ("crash", "collision", "accident")
FIRE_WORDS = ("fire", "smoke", "burn")
INJURY_WORDS = ("injur", "hurt", "hospital")
PRIORITY_TOP = 10
# Binding choice: the days of telemetry that moments of loss are drawn from.
LOSS_EPOCH, LOSS_SECONDS = "2024-01-01 00:00:00", 30 * 86_400
# Warn-only expectations observed per micro-batch on the telemetry stream.
TELEMETRY_EXPECTATIONS = {"speed_plausible": "speed BETWEEN 0 AND 250", "payload_parsed": "k IS NOT NULL"}


def _any_word(c, words):
    cond = F.lit(False)
    for w in words:
        cond = cond | c.contains(w)
    return cond


def fact_complaint(spark, sf_dir):
    """PRJ9 + RAG1 + AGG9: complaint narratives (documents) conformed with
    crash / fire / injury flags."""
    d = t(spark, sf_dir, "documents").select("doc_id", "lang", "source", clean_text("text").alias("narrative"))
    low = F.lower("narrative")
    return d.select("doc_id", "lang", "source",
                    F.length("narrative").alias("n_chars"),
                    F.size(F.split("narrative", " ")).alias("n_words"),
                    _any_word(low, CRASH_WORDS).alias("crash"),
                    _any_word(low, FIRE_WORDS).alias("fire"),
                    _any_word(low, INJURY_WORDS).alias("injury"))


def _claim_frame(spark, sf_dir):
    """Every claim with its policyholder, under a number, written once.  The id
    is written in binary; what follows from it is derived where it is read."""
    return materialize(claims.with_holder(claims.claim_valid(spark, sf_dir), spark, sf_dir).select(
        F.monotonically_increasing_id().alias("_n"), F.unhex("claim_id").alias("claim_id"), "source_system", "policy_id",
        "incident_date", F.col("total_claim_amount").cast("double").alias("claim_amount"),
        F.col("fraud").cast("int").alias("is_fraud"),
        F.pmod(portable_seed("claim_id"), F.lit(LOSS_SECONDS)).cast("int").alias("_drawn")), "claim_frame")


def mart_claim_360(spark, sf_dir):
    """JN2 + JN3 + JN4 + JN5 + JN7 + AGG14: each claim with its policyholder
    (segment, region), the policy tier valid at the incident, the bridged
    vehicle and its driver risk, the last telemetry reading at or before the
    loss, and the conditions of that reading's grid cell.

    Claim dates (1995-2001) precede the telemetry (30 days from
    ``LOSS_EPOCH``), so the moment of loss is drawn from those days by the
    claim's seed.  The ordered lookups shuffle the claims' numbers and their own
    keys only; what they find meets the claim frame by the number."""
    frame = _claim_frame(spark, sf_dir)

    def moment(seconds):
        return F.lit(LOSS_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)

    region = gold.geography(spark, sf_dir).select(F.col("n_nationkey").alias("c_nationkey"), "region")
    vehicle = bridge(t(spark, sf_dir, "customer"), "c_custkey",
                     t(spark, sf_dir, "events").select(F.col("user_id").alias("vehicle_id")), "vehicle_id") \
        .select(F.col("c_custkey").alias("policy_id"), "vehicle_id")
    risk = telematics.driver_risk(spark, sf_dir).select("vehicle_id", "risk_score")
    holder = materialize(star_join(t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("policy_id"), F.col("c_mktsegment").alias("segment"), "c_nationkey"),
        [(region, ["c_nationkey"]), (vehicle, ["policy_id"]), (risk, ["vehicle_id"])]).drop("c_nationkey"),
        "claim_holders")

    tier = point_in_time(
        frame.select("_n", "policy_id", F.col("incident_date").cast("timestamp_ntz").alias("incident_ts")),
        policy.scd2_policyholder(spark, sf_dir), ["policy_id"], "incident_ts", ["tier"], tie="seq_tie") \
        .where("tier IS NOT NULL").select("_n", F.col("tier").alias("tier_at_incident"))

    readings = telematics.telemetry(spark, sf_dir).select(
        "vehicle_id", "ts", "event_id", "speed", grid_cell("lat", "lon", telematics.CELL_DEG).alias("cell"))
    # a policyholder has one vehicle
    vehicles = holder.where("vehicle_id IS NOT NULL").select("policy_id", "vehicle_id").distinct()
    losses = frame.select("_n", "policy_id", "_drawn", moment(F.col("_drawn")).alias("loss_ts")).join(
        small_side(vehicles), "policy_id").drop("policy_id")
    reading = materialize(
        asof_join(losses, readings, ["vehicle_id"], "loss_ts", "ts", ["event_id", "speed", "cell"],
                  right_tie="event_id", prefix="at_loss_")
        # a reading without a time comes before all others, so its time tells nothing
        .where("at_loss_ts IS NOT NULL OR at_loss_event_id IS NOT NULL OR at_loss_speed IS NOT NULL OR at_loss_cell IS NOT NULL")
        .select("_n", moment(F.col("_drawn") - F.col("_drawn") % 3600).alias("_hour"), "at_loss_ts",
                "at_loss_event_id", "at_loss_speed", F.col("at_loss_cell").alias("cell")), "claim_readings")
    # conditions hold from one full hour to the next: an hour's losses in a cell share them
    hours = reading.where("cell IS NOT NULL").select("cell", "_hour").distinct()
    conditions = materialize(
        asof_join(hours, telematics.cell_conditions(spark, sf_dir), ["cell"], "_hour", "obs_ts",
                  ["avg_speed", "n_events"], prefix="cell_"), "claim_conditions")
    reading = star_join(reading, [(conditions, ["cell", "_hour"])])

    frame = frame.join(tier, "_n", "left").join(reading, "_n", "left")
    return star_join(frame, [(holder, ["policy_id"])]).select(
        F.lower(F.hex("claim_id")).alias("claim_id"), "source_system", "policy_id", "segment", "region",
        "tier_at_incident", "vehicle_id", "risk_score", moment(F.col("_drawn")).alias("loss_ts"), "at_loss_ts",
        "at_loss_event_id", "at_loss_speed", "cell", "cell_avg_speed", "cell_n_events", "claim_amount", "is_fraud")


def claim_status_scd2(spark, sf_dir):
    """CDC5: claim status kept as SCD2 history (key claim_id)."""
    h = claims.claim_history_by_claim(spark, sf_dir).select(
        "claim_id", "status", F.col("status_date").cast("timestamp_ntz").alias("status_ts"), "seq")
    return scd2(h, ["claim_id"], ["status_ts", "seq"], ["status"], time_chunk("status_ts", "year"),
                coalesce_repeats=False, bounded_versions=True)   # <= 3 statuses per claim


def loss_conditions(spark, sf_dir):
    """JN5: conditions of the loss cell from the latest hourly observation
    published (hour end) at or before the loss; key = grid cell, a few hot
    keys, handled by the chunked as-of join."""
    tel = telematics.telemetry(spark, sf_dir).withColumn("cell", grid_cell("lat", "lon", telematics.CELL_DEG))
    obs = telematics.cell_conditions(spark, sf_dir)
    losses = tel.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("loss_id"), "cell", F.col("ts").alias("loss_ts"))
    return asof_join(losses, obs, ["cell"], "loss_ts", "obs_ts", ["avg_speed", "n_events"],
                     chunk_unit="day", prefix="obs_").withColumnRenamed("obs_obs_ts", "obs_ts")


def row_count_schema(spark, sf_dir):
    """DQ8 + SRC12: count every table of the folder (mode 3, nothing else
    given) in one plan."""
    targets = resolve_targets(None, None, lambda: list_tables(spark, sf_dir))
    return validate_counts(spark, targets, lambda n: read_table(spark, sf_dir, n))


def _severity_feeds(spark, sf_dir):
    """The two severity feeds; the line feed is landed as ARFF and read back."""
    root = scratch_path(spark, "severity_arff")
    li = t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("IDpol"), F.col("l_extendedprice").cast(AMOUNT).alias("ClaimAmount"))
    write_arff(li, root, "line_severity")
    return {"line_feed": scan_arff(spark, root), "order_feed": t(spark, sf_dir, "orders")}


def _severity(feeds):
    mapping = {
        "line_feed": {"policy_id": "IDpol", "claim_amount": to_amount("ClaimAmount")},
        "order_feed": {"policy_id": "o_custkey", "claim_amount": to_amount("o_totalprice"),
                       "claim_type": "o_orderpriority"},
    }
    return union_conformed(*[conform(df, mapping[name], SEVERITY, {"source_system": name})
                             for name, df in feeds.items()])


def claim_severity(spark, sf_dir):
    """SRC17 + PRJ7: two severity feeds conformed and unioned."""
    return _severity(_severity_feeds(spark, sf_dir))


def severity_recon(spark, sf_dir):
    """DQ12: the union's rows against its feeds'."""
    feeds = _severity_feeds(spark, sf_dir)
    rows = materialize(_severity(feeds), "severity_recon")
    return severity_reconciliation(feeds, rows.where("claim_amount IS NOT NULL"), rows.where("claim_amount IS NULL"))


def claim_priority(spark, sf_dir):
    """SRT2: the open (under review) source-A claims with the largest
    amounts, top 10 per claim type (a top-k report: the limit is the
    feature; Spark limits per task before the shuffle)."""
    c = claims.claim_valid(spark, sf_dir).where(
        (F.col("source_system") == "orders") & F.col("settlement_date").isNull())
    w = Window.partitionBy("claim_type").orderBy(F.col("total_claim_amount").desc(), "claim_id")
    return (c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= PRIORITY_TOP)
             .select("claim_type", "rank", "claim_id", F.col("total_claim_amount").cast("double").alias("amount")))


def fact_telemetry_event(spark, sf_dir):
    """AGG12: typed telemetry fact."""
    return telematics.telemetry(spark, sf_dir)


def stream_telemetry_split(spark, sf_dir):
    """STR8 + DQ4: one telemetry stream, each micro-batch written to a valid
    and a quarantine table (``foreachBatch``, idempotent per batch id)."""
    root = scratch_path(spark, "telemetry_split")
    tel = telematics.telemetry(spark, sf_dir)
    tel.write.parquet(f"{root}/landing")
    c = F.col
    rules = {"speed_out_of_range": (c("speed") < 0) | (c("speed") > telematics.SPEED_MAX_PLAUSIBLE),
             "gps_invalid": ~c("lat").between(-90, 90) | ~c("lon").between(-180, 180),
             "bad_payload": c("k").isNull()}

    def split(batch: DataFrame, batch_id: int) -> None:
        # written once, partitioned by the flag
        apply_rules(batch, rules).write.mode("overwrite").partitionBy("is_valid") \
            .parquet(f"{root}/rows/batch_id={batch_id}")

    src = observe_expectations(
        spark.readStream.schema(tel.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/landing"),
        "telemetry_dq", TELEMETRY_EXPECTATIONS)
    q = (src.writeStream.foreachBatch(split).option("checkpointLocation", f"{root}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/rows").select(
        "event_id", F.when(F.col("is_valid").cast("boolean"), "valid").otherwise("quarantine").alias("branch"), "quarantine_reason")


SAMPLE_TABLES = ("region", "nation", "supplier")
SAMPLE_ROWS = 5


def gate_evidence(spark, sf_dir):
    """SRT1: the first rows of each table under a total order, as JSON (a
    sampling report: the limit is the feature; ``orderBy + limit`` runs as a
    per-task top-k, no full sort)."""
    frames = []
    for name in SAMPLE_TABLES:
        d = t(spark, sf_dir, name)
        cols = d.columns
        top = d.orderBy(*cols).limit(SAMPLE_ROWS)
        w = Window.orderBy(*cols)   # over at most SAMPLE_ROWS rows
        frames.append(top.select(F.lit(name).alias("table"), F.row_number().over(w).alias("rn"),
                                 F.to_json(F.struct(*cols)).alias("row_json")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def dim_policy(spark, sf_dir):
    """PRJ11: two policy portfolios (retail = customers, fleet = suppliers)
    conformed to one policy feed."""
    cust = t(spark, sf_dir, "customer").select(
        F.concat(F.lit("R-"), F.col("c_custkey").cast("string")).alias("policy_key"),
        F.lit("retail").alias("portfolio"), F.col("c_name").alias("holder"),
        F.col("c_nationkey").alias("nation_key"), F.col("c_mktsegment").alias("segment"),
        to_amount(F.col("c_acctbal")).alias("balance"))
    supp = t(spark, sf_dir, "supplier").select(
        F.concat(F.lit("F-"), F.col("s_suppkey").cast("string")).alias("policy_key"),
        F.lit("fleet").alias("portfolio"), F.col("s_name").alias("holder"),
        F.col("s_nationkey").alias("nation_key"), F.lit(None).cast("string").alias("segment"),
        to_amount(F.col("s_acctbal")).alias("balance"))
    return union_conformed(cust, supp)


def scd2_driver(spark, sf_dir):
    """CDC8: driver dimension as SCD2 (key driver, sequence = event time):
    each telemetry event observes the driver's current activity; unchanged
    repeats are coalesced, so a version opens only when the activity
    changes.  Day chunks keep a very active driver off a single task."""
    e = t(spark, sf_dir, "events").select(
        F.col("user_id").alias("driver_id"), F.col("event_type").alias("activity"),
        F.col("ts").alias("effective_ts"), "event_id")
    return scd2(e, ["driver_id"], ["effective_ts", "event_id"], ["activity"],
                time_chunk("effective_ts", "day"), coalesce_repeats=True)
