"""Query registry: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratum.plans import (checks, claims, extra, features, gold, governance, marts, policy,
                           streams, telematics)
from stratum.plans.common import present

Query = Callable[[SparkSession, str], DataFrame]


def _claim_lifecycle(spark, sf):
    return claims.enriched(spark, sf).select(
        "claim_id", "source_system", "fraud", "fnol_date", "claim_status",
        "settlement_date", "cycle_time_days")


_RAW: dict[str, Query] = {
    "conform_claims": claims.deduped,
    "claim_lifecycle": _claim_lifecycle,
    "claim_valid": claims.claim_valid,
    "claim_quarantine": claims.claim_quarantine,
    "claim_status_history": claims.claim_history,
    "scd2_policyholder": policy.scd2_policyholder,
    "scd2_repeats_coalesced": policy.scd2_repeats_coalesced,
    "endorsement_current": policy.endorsement_current,
    "upsert_latest": policy.upsert_latest,
    "policy_lapses": policy.policy_lapses,
    "policy_inforce_monthly": policy.policy_inforce_monthly,
    "policy_transactions": policy.policy_transactions,
    "telemetry_quarantine": telematics.telemetry_quarantine,
    "trips_by_gap": telematics.trips_by_gap,
    "trips_by_ignition": telematics.trips_by_ignition,
    "fact_trip": telematics.fact_trip,
    "fact_trip_merge": telematics.fact_trip_merge,
    "trip_star": telematics.trip_star,
    "trip_daily": telematics.trip_daily,
    "driver_risk": telematics.driver_risk,
    "grid_cells": telematics.grid_cells,
    "dim_date": gold.dim_date,
    "dim_claim_type": gold.dim_claim_type,
    "dim_claim_status": gold.dim_claim_status,
    "dim_geography": gold.dim_geography,
    "dim_incident": gold.dim_incident,
    "dim_coverage": gold.dim_coverage,
    "star_claims": gold.star_claims,
    "point_in_time_policy": gold.point_in_time_policy,
    "asof_telemetry": gold.asof_telemetry,
    "interval_telemetry": gold.interval_telemetry,
    "bridge_keys": gold.bridge_keys,
    "policy_claims": gold.policy_claims,
    "claim_frequency": gold.claim_frequency,
    "recall_match": gold.recall_match,
    "mart_claims_kpi": marts.mart_claims_kpi,
    "kpi_reconciles": marts.kpi_reconciles,
    "kpi_rollup": marts.kpi_rollup_q,
    "mart_claim_percentiles": marts.mart_claim_percentiles,
    "kpi_percentiles_hold": marts.kpi_percentiles_hold,
    "distinct_vehicles": marts.distinct_vehicles,
    "mart_fraud_signals": marts.mart_fraud_signals,
    "claim_lifecycle_snapshot": marts.claim_lifecycle_snapshot,
    "claim_status_fact": marts.claim_status_fact,
    "claim_payments_running": marts.claim_payments_running,
    "quality_metrics": checks.quality_metrics,
    "recon_identity": checks.recon_identity,
    "quarantine_reasons": checks.quarantine_reasons,
    "claim_status_dist": checks.claim_status_dist,
    "history_coverage": checks.history_coverage,
    "scd2_invariants": checks.scd2_invariants,
    "row_count_validation": checks.row_count_validation,
    "volume_floor": checks.volume_floor,
    "customer_tags": governance.customer_tags,
    "masked_customers": governance.masked_customers,
    "tenant_orders": governance.tenant_orders,
    "feature_fraud": features.feature_fraud,
    "fraud_scores": features.fraud_scores,
    "fraud_auc": features.fraud_auc,
    "severity_pred": features.severity_pred,
    "severity_error": features.severity_error,
    "doc_chunks": features.doc_chunks,
    "similar_topk": features.similar_topk,
    "similar_claims": features.similar_claims,
    "claim_evidence": features.claim_evidence,
    "similar_vectors": features.similar_vectors,
    "similar_vectors_lsh": features.similar_vectors_lsh,
    "similar_claims_lsh": features.similar_claims_lsh,
    "search_recall": features.search_recall,
    "claim_context": features.claim_context,
    "bronze_ingest": streams.bronze_ingest,
    "bronze_evolving": streams.bronze_evolving,
    "stream_scd2": streams.stream_scd2,
    "stream_policyholder": streams.stream_policyholder,
    "stream_vehicle": streams.stream_vehicle,
    "stream_late_rows": streams.stream_late_rows,
    "stream_sliding_windows": streams.stream_sliding_windows,
    "stream_sessions": streams.stream_sessions,
    "stream_windows": streams.stream_windows,
    "stream_dedup": streams.stream_dedup,
    "stream_ignition_trips": streams.stream_ignition_trips,
    "stream_trip_ends": streams.stream_trip_ends,
    "fact_complaint": extra.fact_complaint,
    "mart_claim_360": extra.mart_claim_360,
    "claim_status_scd2": extra.claim_status_scd2,
    "loss_conditions": extra.loss_conditions,
    "row_count_schema": extra.row_count_schema,
    "severity_recon": extra.severity_recon,
    "claim_severity": extra.claim_severity,
    "claim_priority": extra.claim_priority,
    "fact_telemetry_event": extra.fact_telemetry_event,
    "stream_telemetry_split": extra.stream_telemetry_split,
    "gate_evidence": extra.gate_evidence,
    "dim_policy": extra.dim_policy,
    "scd2_driver": extra.scd2_driver,
}


def queries() -> dict[str, Query]:
    return {name: (lambda fn: (lambda spark, sf: present(fn(spark, sf))))(fn)
            for name, fn in _RAW.items()}
