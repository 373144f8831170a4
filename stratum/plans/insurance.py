"""Claims silver over the raw insurance bronze tables (all-string columns,
layouts as landed by ``stratum.config.CLAIM_SOURCES``).

``silver(read)`` returns the silver frames lazily; ``run_silver`` writes
them, materialising the shared enriched claims once so the valid and
quarantine tables come from the same rows.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegerType, StringType, StructField, StructType

from stratum.functions.dates import month_number, parse_date_multi, safe_make_date
from stratum.functions.flags import flag_in, flag_upper_equals
from stratum.functions.keys import surrogate_key
from stratum.functions.money import AMOUNT, to_amount
from stratum.operators.cdc import scd2
from stratum.operators.conform import CLAIM_KEY_FIELDS, CLAIM_SCHEMA, conform, union_conformed
from stratum.operators.dedup import dedup_first
from stratum.operators.governance import resolve_columns
from stratum.operators.lifecycle import add_lifecycle, status_history
from stratum.operators.ordered import time_chunk
from stratum.operators.quality import claim_rules, reason_column
from stratum.plans.claims import CLAIM_COLS, QUARANTINE_COLS
from stratum.sinks import materialize

Reader = Callable[[str], DataFrame]
c = F.col
log = logging.getLogger(__name__)

# Raw column layout of each bronze source, as landed.
RAW_COLUMNS = {
    "raw_insurance_claims": (
        "policy_number", "incident_date", "incident_type", "incident_severity", "total_claim_amount",
        "injury_claim", "property_claim", "vehicle_claim", "auto_make", "auto_model", "auto_year",
        "fraud_reported", "insured_zip", "incident_location", "age", "insured_sex", "policy_state",
        "insured_education_level", "insured_occupation"),
    "raw_carclaims": ("PolicyNumber", "Year", "Month", "FraudFound", "Make", "AccidentArea", "Age",
                      "Sex", "Fault", "VehicleCategory"),
    "raw_claim_severity": ("IDpol", "ClaimAmount"),
    "raw_claims_by_type": ("ID", "Cost_claims_by_type", "Claims_type", "Cost_claims_year"),
}
RAW_COLUMNS["raw_complaints"] = ("MAKETXT", "MODELTXT", "YEARTXT", "CRASH", "FIRE", "INJURED", "DEATHS", "FAILDATE",
                                 "VIN", "CITY", "STATE", "CDESCR")
_METADATA = ("_ingest_ts", "_source_file")


def raw_layout(df: DataFrame, expected) -> DataFrame:
    """Expected raw columns resolved case-insensitively; a column missing
    from the landed file (schema drift) becomes a NULL string and a warning
    instead of failing the pipeline.  Ingest metadata is kept."""
    found, missing = resolve_columns(df, list(expected) + list(_METADATA))
    for m in missing:
        log.warning("raw column missing, treated as NULL: %s", m)
    cols = [(c(found[n]) if n in found else F.lit(None).cast("string")).alias(n) for n in expected]
    meta = [(c(found[n]) if n in found else F.lit(None)).alias(n) for n in _METADATA]
    return df.select(*cols, *meta)


def _with_layout(read: Reader) -> Reader:
    return lambda name: raw_layout(read(name), RAW_COLUMNS[name]) if name in RAW_COLUMNS else read(name)


@dataclass(frozen=True)
class Parsed:
    """A target whose value is parsed from raw text: what can't be parsed is
    NULL and a quarantine reason ``bad_<target>``."""

    raw: tuple[str, ...]
    parse: Callable[..., Column]

    def typed(self) -> Column:
        return self.parse(*self.raw)

    def failed(self) -> Column:
        given = F.concat_ws("", *[F.trim(c(r)) for r in self.raw])
        return (given != "") & self.typed().isNull()


@dataclass(frozen=True)
class Feed:
    """One raw claims table on the claim grain: target -> raw column or Parsed."""

    table: str
    system: str
    synthetic_date: bool
    fields: dict[str, str | Parsed]

    def mapping(self) -> dict[str, Column]:
        return {t: f.typed() if isinstance(f, Parsed) else c(f) for t, f in self.fields.items()}

    def parsed(self) -> dict[str, Parsed]:
        return {t: f for t, f in self.fields.items() if isinstance(f, Parsed)}


def whole(raw: str) -> Column:
    return c(raw).try_cast("int")


def mid_month(year: str, month: str) -> Column:
    return safe_make_date(whole(year), month_number(month), F.lit(15))


CLAIM_FEEDS = (
    Feed("raw_insurance_claims", "insurance_claims", False, {
        "policy_number": "policy_number", "incident_date": Parsed(("incident_date",), parse_date_multi),
        "claim_type": "incident_type", "severity": "incident_severity",
        **{t: Parsed((t,), to_amount) for t in
           ("total_claim_amount", "injury_claim", "property_claim", "vehicle_claim")},
        "policyholder_age": Parsed(("age",), whole), "auto_year": Parsed(("auto_year",), whole),
        "auto_make": "auto_make", "auto_model": "auto_model",
        "fraud": Parsed(("fraud_reported",), flag_upper_equals),
        "insured_zip": "insured_zip", "incident_location": "incident_location", "policyholder_sex": "insured_sex"}),
    Feed("raw_carclaims", "carclaims", True, {
        "policy_number": "PolicyNumber", "incident_date": Parsed(("Year", "Month"), mid_month),
        "auto_make": "Make", "fraud": Parsed(("FraudFound",), flag_in), "incident_location": "AccidentArea",
        "policyholder_age": Parsed(("Age",), whole), "policyholder_sex": "Sex", "fault": "Fault",
        "vehicle_category": "VehicleCategory"}),
)


def conform_feed(raw: DataFrame, feed: Feed) -> DataFrame:
    """The feed's rows on ``CLAIM_SCHEMA`` with ``_cast_errors`` (the reasons
    of failed casts) and ``_failed_text`` (their raw text, which keeps rows
    apart that are equal once typed)."""
    parsed = feed.parsed()
    errors = F.concat_ws("; ", *[F.when(f.failed(), F.lit(f"bad_{t}")) for t, f in parsed.items()])
    text = F.concat_ws("|", *[F.when(f.failed(), c(r)) for f in parsed.values() for r in f.raw])
    extra = StructType([*CLAIM_SCHEMA.fields, *[StructField(n, StringType()) for n in
                                               ("_cast_errors", "_failed_text", "_source_file")],
                        StructField("_ingest_ts", raw.schema["_ingest_ts"].dataType)])
    return conform(raw, {**feed.mapping(), "_cast_errors": F.nullif(errors, F.lit("")),
                         "_failed_text": F.nullif(text, F.lit("")), "_source_file": "_source_file",
                         "_ingest_ts": "_ingest_ts"}, extra,
                   constants={"source_system": feed.system, "incident_date_is_synthetic": feed.synthetic_date})


def claim_input(read: Reader) -> DataFrame:
    """All claim rows that came in, on the claim grain with their content key."""
    read = _with_layout(read)
    u = union_conformed(*[conform_feed(read(feed.table), feed) for feed in CLAIM_FEEDS])
    return u.withColumn("claim_id", F.when(c("_failed_text").isNull(), surrogate_key(*CLAIM_KEY_FIELDS))
                        .otherwise(surrogate_key(*CLAIM_KEY_FIELDS, "_failed_text")))


def silver(read: Reader) -> dict[str, DataFrame]:
    u = claim_input(read)
    read = _with_layout(read)
    payload = CLAIM_SCHEMA.fieldNames()
    d = dedup_first(u, ["claim_id"], order_by=payload + ["_cast_errors", "_failed_text", "_source_file", "_ingest_ts"])
    life = add_lifecycle(d)
    rules = claim_rules("insurance_claims")
    reason = F.concat_ws("; ", reason_column(rules), c("_cast_errors"))
    enriched = (life.withColumn("quarantine_reason", F.when(F.length(reason) > 0, reason))
                    .withColumn("is_valid", c("quarantine_reason").isNull()))
    return {"claim_enriched": enriched,
            "claim_severity": severity(read),
            "dim_policyholder": dim_policyholder(read),
            "dim_vehicle": dim_vehicle(read)}


def claim_tables(enriched: DataFrame) -> dict[str, DataFrame]:
    claim = enriched.where("is_valid").select(*CLAIM_COLS, "_source_file", "_ingest_ts")
    return {"claim": claim,
            "claim_quarantine": enriched.where("NOT is_valid").select(*QUARANTINE_COLS),
            "claim_status_history": status_history(claim)}


# Target layouts of the severity table and the two dimensions.
def _layout(text: str, types: dict) -> StructType:
    return StructType([StructField(n, types.get(n, StringType())) for n in text.split()])


SEVERITY = _layout("source_system policy_id claim_amount claim_type year_total_cost",
                   {"claim_amount": AMOUNT, "year_total_cost": AMOUNT})
HOLDER = _layout("policy_number source_system age sex zip state education occupation", {"age": IntegerType()})
VEHICLE = _layout("make model model_year category", {"model_year": IntegerType()})

COMPLAINT = _layout("complaint_key make model model_year crash fire injured deaths fail_date vin city state narrative "
                    "bad_fields", {"model_year": IntegerType(), "crash": BooleanType(), "fire": BooleanType(),
                                   "injured": IntegerType(), "deaths": IntegerType(), "fail_date": DateType()})


def compact_date(raw: str) -> Column:
    """``yyyyMMdd``."""
    return F.try_to_timestamp(c(raw), F.lit("yyyyMMdd")).cast("date")


COMPLAINT_FIELDS = {
    "make": "MAKETXT", "model": "MODELTXT", "vin": "VIN", "city": "CITY", "state": "STATE", "narrative": "CDESCR",
    **{t: Parsed((r,), whole) for t, r in (("model_year", "YEARTXT"), ("injured", "INJURED"), ("deaths", "DEATHS"))},
    **{t: Parsed((r,), flag_upper_equals) for t, r in (("crash", "CRASH"), ("fire", "FIRE"))},
    "fail_date": Parsed(("FAILDATE",), compact_date),
}


def complaint(read: Reader) -> DataFrame:
    """Complaints typed, one row per distinct raw row; fields that can't be
    parsed are NULL and named in ``bad_fields``."""
    raw = _with_layout(read)("raw_complaints")
    parsed = {t: f for t, f in COMPLAINT_FIELDS.items() if isinstance(f, Parsed)}
    bad = F.concat_ws("; ", *[F.when(f.failed(), F.lit(f"bad_{t}")) for t, f in parsed.items()])
    mapping = {t: f.typed() if isinstance(f, Parsed) else f for t, f in COMPLAINT_FIELDS.items()}
    return conform(raw, {**mapping, "complaint_key": surrogate_key(*RAW_COLUMNS["raw_complaints"]),
                         "bad_fields": F.nullif(bad, F.lit(""))}, COMPLAINT).distinct()


# target -> raw column, by raw table
SEVERITY_FEEDS = {
    "raw_claim_severity": ("freMTPL2sev", {"policy_id": "IDpol", "claim_amount": "ClaimAmount"}),
    "raw_claims_by_type": ("spanish_by_type", {
        "policy_id": "ID", "claim_amount": "Cost_claims_by_type", "claim_type": "Claims_type",
        "year_total_cost": "Cost_claims_year"}),
}
HOLDER_FEEDS = {
    "raw_insurance_claims": ("insurance_claims", {
        "policy_number": "policy_number", "age": "age", "sex": "insured_sex", "zip": "insured_zip",
        "state": "policy_state", "education": "insured_education_level", "occupation": "insured_occupation"}),
    "raw_carclaims": ("carclaims", {"policy_number": "PolicyNumber", "age": "Age", "sex": "Sex"}),
}
VEHICLE_FEEDS = {
    "raw_insurance_claims": ("insurance_claims", {
        "make": "auto_make", "model": "auto_model", "model_year": "auto_year"}),
    "raw_carclaims": ("carclaims", {"make": "Make", "category": "VehicleCategory"}),
}


def _conformed(read: Reader, feeds: dict, schema: StructType, lineage: dict[str, str] | None = None) -> DataFrame:
    """All ``feeds`` on ``schema``, by the module-wide conform; ``lineage``
    names the ingest columns to carry (raw name -> target)."""
    frames = []
    for table, (system, mapping) in feeds.items():
        raw = read(table)
        carried = [StructField(target, raw.schema[name].dataType) for name, target in (lineage or {}).items()]
        frames.append(conform(raw, {**mapping, **{t: n for n, t in (lineage or {}).items()}},
                              StructType([*schema.fields, *carried]), constants={"source_system": system}))
    return union_conformed(*frames)


def severity(read: Reader) -> DataFrame:
    """Both severity feeds.  An amount that isn't a number is NULL and named in
    ``bad_amounts``, which ``run_silver`` writes to a quarantine table."""
    targets = ("claim_amount", "year_total_cost")
    frames = []
    for table, (system, mapping) in SEVERITY_FEEDS.items():
        raw = read(table)
        failed = F.concat_ws("; ", *[F.when(Parsed((mapping[t],), to_amount).failed(), F.lit(f"bad_{t}"))
                                     for t in targets if t in mapping])
        frames.append(conform(raw, {**mapping, "bad_amounts": F.nullif(failed, F.lit(""))},
                              StructType([*SEVERITY.fields, StructField("bad_amounts", StringType())]),
                              constants={"source_system": system}))
    return union_conformed(*frames)


def dim_policyholder(read: Reader) -> DataFrame:
    attributes = HOLDER.fieldNames()[2:]
    changes = _conformed(read, HOLDER_FEEDS, HOLDER, {"_ingest_ts": "seq_ts", "_source_file": "seq_file"})
    # last-resort tie inside one file: a hash of the attributes (deterministic)
    return scd2(changes.withColumn("seq_tie", surrogate_key(*attributes)), HOLDER.fieldNames()[:2],
                ["seq_ts", "seq_file", "seq_tie"], attributes, time_chunk("seq_ts", "month"))


def dim_vehicle(read: Reader) -> DataFrame:
    attributes = VEHICLE.fieldNames()
    seen = _conformed(read, VEHICLE_FEEDS, VEHICLE, {"_ingest_ts": "seq_ts"})
    return scd2(seen.withColumn("vehicle_key", surrogate_key(*attributes)), ["vehicle_key"], ["seq_ts"],
                attributes, time_chunk("seq_ts", "month"))


def run_silver(read: Reader, write: Callable[[str, DataFrame], None],
               complaints: bool = False) -> dict[str, DataFrame]:
    """Build and write every silver table; the enriched claims are
    materialised once and both sides of the split read the same files."""
    s = silver(read)
    enriched = materialize(s["claim_enriched"], "claim_enriched")
    sev = materialize(s["claim_severity"], "claim_severity")
    out = {**claim_tables(enriched),
           "claim_severity": sev.where("bad_amounts IS NULL").drop("bad_amounts"),
           "claim_severity_quarantine": sev.where("bad_amounts IS NOT NULL"),
           "dim_policyholder": s["dim_policyholder"], "dim_vehicle": s["dim_vehicle"]}
    if complaints:                      # the feed may not have landed
        out["complaint"] = complaint(read)
    for name, df in out.items():
        write(name, df)
    return out
