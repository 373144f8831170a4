"""Job entry points for the insurance layout: bronze ingest, row-count
validation, silver build with its checks.  Each returns a JSON summary
(machine-readable run result) and raises when a gate fails."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.config import CLAIM_SOURCES
from stratum.operators.quality import (GateFailed, breakdown, coverage, reconcile, severity_reconciliation,
                                       validate_counts)
from stratum.plans.insurance import SEVERITY_FEEDS, claim_input, run_silver
from stratum.sinks import run_summary
from stratum.sources.files import Source
from stratum.sources.ingest import ingest_all
from stratum.sources.tables import Catalog


def bronze_job(spark: SparkSession, landing: str, bronze_root: str, checkpoint_root: str,
               sources: Sequence[Source] = CLAIM_SOURCES) -> str:
    status = ingest_all(spark, sources, landing, bronze_root, checkpoint_root, batch_id=str(uuid.uuid4()))
    return run_summary(spark, status)


def validate_job(spark: SparkSession, bronze_root: str, expected: Mapping[str, int | None],
                 fail_on_mismatch: bool = True) -> str:
    res = validate_counts(spark, dict(expected), lambda n: Catalog(bronze_root).read(spark, n))
    summary = run_summary(spark, res)
    if fail_on_mismatch and any(r["status"] not in ("PASS", "COUNT") for r in json.loads(summary)):
        raise GateFailed(summary)
    return summary


def silver_job(spark: SparkSession, bronze_root: str, silver_root: str) -> str:
    """Build every silver table from the bronze tables, then check: claims
    reconcile exactly on their content key (valid + quarantined + duplicates =
    input), severity rows reconcile with their feeds, one open SCD2 version
    per policyholder, history coverage."""
    bronze, silver = Catalog(bronze_root), Catalog(silver_root)

    def read(name: str) -> DataFrame:
        return bronze.read(spark, name)

    def write(name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(silver.path(name))

    run_silver(read, write, complaints=bronze.exists(spark, "raw_complaints"))
    s = {n: silver.read(spark, n) for n in
         ("claim", "claim_quarantine", "claim_status_history", "claim_severity", "claim_severity_quarantine",
          "dim_policyholder", "dim_vehicle")}
    keyed = claim_input(read)
    recon = reconcile(keyed, s["claim"], s["claim_quarantine"], "claim_id").first().asDict()
    holders = s["dim_policyholder"].groupBy("policy_number", "source_system").agg(
        F.count_if("is_current").alias("open")).agg(F.count_if(F.col("open") != 1).alias("n")).first()["n"]
    history = coverage(s["claim"], s["claim_status_history"], "claim_id").first().asDict()
    statuses = {r["status"]: r["n"] for r in breakdown(s["claim_status_history"], "status").collect()}
    severity = severity_reconciliation(
        {n: read(n) for n in SEVERITY_FEEDS}, s["claim_severity"], s["claim_severity_quarantine"])
    checks = {
        "claims_reconcile": recon["identity_ok"],
        "one_current_version_per_policyholder": holders == 0,
        "history_covers_claims": history["missing_keys"] == 0,
        "severity_reconciles": severity.first()["identity_ok"],
    }
    out = {"rows": {k: v.count() for k, v in s.items()}, "checks": checks, "history_status_dist": statuses,
           "duplicates_removed": recon["duplicates_removed"]}
    if not all(checks.values()):
        raise GateFailed(json.dumps(out))
    return json.dumps(out)
