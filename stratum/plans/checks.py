"""Quality reports over the claims pipeline and the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators.ordered import neighbour, time_chunk
from stratum.operators.quality import (breakdown, coverage, expectation_metrics,
                                       reconcile, resolve_targets, validate_counts)
from stratum.operators.lifecycle import status_history
from stratum.plans import claims, policy
from stratum.sinks import materialize, materialize_keyed
from stratum.plans.common import t

# Warn-only expectations measured BEFORE the valid/quarantine split.
CLAIM_EXPECTATIONS = {
    "amount_non_negative": "total_claim_amount IS NULL OR total_claim_amount >= 0",
    "age_valid": "policyholder_age IS NULL OR policyholder_age >= 16",
    "incident_date_present": "incident_date IS NOT NULL",
    "fnol_after_incident": "fnol_date >= incident_date",
}


def quality_metrics(spark, sf_dir):
    return expectation_metrics(claims.enriched(spark, sf_dir), CLAIM_EXPECTATIONS)


def recon_identity(spark, sf_dir):
    """Reconcile the written silver split against the conformed input: the
    enriched claims are written once (shared checkpoint folder) and both
    sides of the split are read from those files, as the silver tables are."""
    enriched = materialize(claims.enriched(spark, sf_dir), "recon_enriched")
    # ids in binary: half the bytes to shuffle
    return reconcile(*[d.withColumn("claim_id", F.unhex("claim_id")) for d in (
        claims.conformed(spark, sf_dir), enriched.where("is_valid"), enriched.where("NOT is_valid"))], "claim_id")


def quarantine_reasons(spark, sf_dir):
    return breakdown(claims.claim_quarantine(spark, sf_dir), "quarantine_reason")


def claim_status_dist(spark, sf_dir):
    return breakdown(claims.claim_valid(spark, sf_dir), "claim_status")


def history_coverage(spark, sf_dir):
    """Every written claim has history rows: the claims are written once and
    the history is derived from those files, as in the silver flow."""
    claim = materialize_keyed(claims.claim_valid(spark, sf_dir).select(
        "claim_id", "source_system", "fnol_date", "claim_status", "settlement_date"), "coverage_claim", "claim_id")
    return coverage(claim, status_history(claim), "claim_id")


def scd2_invariants(spark, sf_dir):
    """DQ14: one open version per key, current rows = distinct keys, no
    overlapping intervals (checked against the previous version)."""
    d = policy.scd2_policyholder(spark, sf_dir)
    p = neighbour(d, ["policy_id"], ["effective_from", "seq_tie"],
                  time_chunk("effective_from", "year"), carry=["effective_to"], direction="prev")
    # one aggregate has every metric
    before, start = F.col("prev_effective_to"), F.col("effective_from")
    m = p.agg(F.count(F.lit(1)).alias("n_versions"),
              F.count_if(F.col("effective_to").isNull()).alias("n_current"),
              F.count_distinct("policy_id").alias("n_keys"),
              F.count_if(before > start).alias("n_overlaps"), F.count_if(before < start).alias("n_gaps"))
    return m.withColumn("current_eq_keys", F.col("n_current") == F.col("n_keys"))


# Row-count validation targets (mode 1 expectations, mode 2 count-only, and a
# table that does not exist, which must surface as ERROR, not crash).
COUNT_EXPECTATIONS = {"region": 5, "nation": 25}
COUNT_TABLES = ["customer", "supplier", "claims_archive"]
VOLUME_FLOOR = 50_000
VOLUME_TABLES = ["lineitem", "orders", "events"]


def row_count_validation(spark, sf_dir):
    targets = resolve_targets(COUNT_EXPECTATIONS, COUNT_TABLES)
    return validate_counts(spark, targets, lambda n: t(spark, sf_dir, n))


def volume_floor(spark, sf_dir):
    targets = {n: VOLUME_FLOOR for n in VOLUME_TABLES}
    return validate_counts(spark, targets, lambda n: t(spark, sf_dir, n), op=">=")
