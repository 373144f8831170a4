"""Source registry of the insurance domain (SRC2, SRC19) and naming.

Fixed values: landed file families, their layouts and PII columns.
"""

from __future__ import annotations

from stratum.sources.files import Source

# Claims landing registry (file, separator, header, PII).
CLAIM_SOURCES = (
    Source("raw_insurance_claims", "claims", "insurance_claims.csv", "csv", ",", True,
           pii=("policy_number", "insured_zip", "incident_location")),
    Source("raw_carclaims", "claims", "carclaims.csv", "csv", ",", True, pii=("PolicyNumber",)),
    Source("raw_claims_by_type", "claims", "sample_type_claim.csv", "csv", ";", True, pii=("ID",)),
    Source("raw_claim_severity", "claims", "freMTPL2sev.csv", "csv", ",", True, pii=("IDpol",)),
    Source("raw_complaints", "claims", "FLAT_CMPL.txt", "csv", "\t", False,
           columns=("MAKETXT", "MODELTXT", "YEARTXT", "CRASH", "FIRE", "INJURED", "DEATHS",
                    "FAILDATE", "VIN", "CITY", "STATE", "CDESCR"),
           pii=("VIN", "CITY", "STATE")),
)

# Specified feeds of the policy and telematics domains (layouts named only;
# they use the same ingest path once landed).  Each feed has a folder of its
# own, so no feed takes another's files.
SPECIFIED_SOURCES = (
    *[Source(f"raw_{feed}", f"policy/{feed}", "*.csv") for feed in
      ("policy_portfolio", "policy_risk", "vehicle_recalls")],
    *[Source(f"raw_{feed}", f"telematics/{feed}", "*.csv") for feed in
      ("telematics_ubi", "trip_timeseries", "vehicle_static")],
    Source("raw_policy_events", "policy/policy_events", "*.json", "json"),
)

DOMAINS = ("telematics", "policy", "claims")
LAYERS = ("bronze", "silver", "gold")
