"""Claims silver bound to the driver tables.

Proxy roles: ``orders`` is source A (claims with amounts: policy = customer,
incident date = order date rendered MM/dd/yyyy and parsed back, type =
priority, severity = status, fraud = price above a threshold) and
``lineitem`` is source B (no money; incident date synthetic: day 15 of the
ship month given as a month *name*; policy = order, vehicle = part,
location = supplier, age = quantity, fault = return flag, category = line
number).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.dates import month_number, parse_date_multi, safe_make_date
from stratum.functions.keys import surrogate_key
from stratum.functions.money import AMOUNT, to_amount
from stratum.operators.conform import CLAIM_KEY_FIELDS, CLAIM_SCHEMA, conform, union_conformed
from stratum.operators.dedup import dedup_rare
from stratum.operators.joins import left_join_nonnull
from stratum.operators.lifecycle import add_lifecycle, status_history
from stratum.operators.quality import apply_rules, claim_rules
from stratum.plans.common import t

FRAUD_PRICE_THRESHOLD = 400000  # binding choice: proxy fraud label on orders
# binding choice: tenths of a source-A amount that are injury and property,
# the remainder of these divisions; the rest is the vehicle
INJURY_TENTHS_OF_CUSTOMER, PROPERTY_TENTHS_OF_ORDER = 5, 4

# Published columns of the claim and quarantine tables.
CLAIM_COLS = ["claim_id"] + CLAIM_SCHEMA.fieldNames() + [
    "fnol_date", "claim_status", "settlement_date", "cycle_time_days"]
QUARANTINE_COLS = ["claim_id", "source_system", "policy_number", "incident_date",
                   "claim_type", "total_claim_amount", "policyholder_age",
                   "fnol_date", "settlement_date", "quarantine_reason"]


def conform_orders(orders: DataFrame) -> DataFrame:
    c = F.col
    amount = to_amount(c("o_totalprice"))
    tenth = F.lit(Decimal("0.1"))
    injury = (amount * (c("o_custkey") % INJURY_TENTHS_OF_CUSTOMER).cast("int") * tenth).cast(AMOUNT)
    damage = (amount * (c("o_orderkey") % PROPERTY_TENTHS_OF_ORDER).cast("int") * tenth).cast(AMOUNT)
    return conform(orders, {
        "policy_number": c("o_custkey").cast("string"),
        "incident_date": parse_date_multi(F.date_format("o_orderdate", "MM/dd/yyyy")),
        "claim_type": "o_orderpriority",
        "severity": "o_orderstatus",
        "total_claim_amount": amount, "injury_claim": injury, "property_claim": damage,
        "vehicle_claim": amount - injury - damage,
        "fraud": c("o_totalprice") > FRAUD_PRICE_THRESHOLD,
    }, CLAIM_SCHEMA, constants={"source_system": "orders",
                                "incident_date_is_synthetic": False})


def conform_lineitem(lineitem: DataFrame) -> DataFrame:
    c = F.col
    month = month_number(F.date_format("l_shipdate", "MMMM"))
    return conform(lineitem, {
        "policy_number": c("l_orderkey").cast("string"),
        "incident_date": safe_make_date(F.year("l_shipdate"), month, F.lit(15)),
        "auto_make": c("l_partkey").cast("string"),
        "fraud": c("l_returnflag") == "R",
        "incident_location": c("l_suppkey").cast("string"),
        "policyholder_age": c("l_quantity").cast("int"),
        "policyholder_sex": "l_linestatus",
        "fault": "l_returnflag",
        "vehicle_category": c("l_linenumber").cast("string"),
    }, CLAIM_SCHEMA, constants={"source_system": "lineitem",
                                "incident_date_is_synthetic": True})


def conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sources on the claim grain, keyed by the content hash."""
    u = union_conformed(conform_orders(t(spark, sf_dir, "orders")),
                        conform_lineitem(t(spark, sf_dir, "lineitem")))
    return u.select(surrogate_key(*CLAIM_KEY_FIELDS).alias("claim_id"), *CLAIM_SCHEMA.fieldNames())


def deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per claim: the two sources repeat few claims, so only repeated
    ones are shuffled."""
    df = conformed(spark, sf_dir)
    return dedup_rare(df, ["claim_id"], order_by=CLAIM_SCHEMA.fieldNames())


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(add_lifecycle(deduped(spark, sf_dir)), claim_rules())


def claim_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir).where("is_valid").select(*CLAIM_COLS)


def claim_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir).where("NOT is_valid").select(*QUARANTINE_COLS)


def claim_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_history(claim_valid(spark, sf_dir))


def claim_history_by_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``claim_history`` with the rows of a claim in one partition, for steps
    that need them together: claims are dealt before they become several rows."""
    return status_history(claim_valid(spark, sf_dir).repartition("claim_id"))


def with_holder(claims: DataFrame, spark: SparkSession, sf_dir: str, attributes: tuple[str, ...] = ()) -> DataFrame:
    """``claims`` with ``policy_id``, the policyholder: source A names it,
    source B names the order, whose holder it is.  ``attributes`` are columns of
    ``customer`` to add; they are joined to the orders, which are fewer, so the
    claims are shuffled once, with their ids in binary."""
    orders = t(spark, sf_dir, "orders").select(
        F.lit("lineitem").alias("source_system"), F.col("o_orderkey").cast("string").alias("policy_number"),
        F.col("o_custkey").alias("_holder"))
    if attributes:
        customer = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("_holder"), *attributes)
        named = customer.where("_holder IS NOT NULL").select(
            F.lit("orders").alias("source_system"), F.col("_holder").cast("string").alias("policy_number"),
            "_holder", *attributes)
        orders = left_join_nonnull(orders, customer, ["_holder"]).select(named.columns).unionByName(named)
    named_id = F.when(F.col("source_system") == "orders", F.col("policy_number").try_cast("bigint"))
    joined = left_join_nonnull(claims.withColumn("claim_id", F.unhex("claim_id")), orders,
                               ["source_system", "policy_number"])
    return (joined.withColumn("claim_id", F.lower(F.hex("claim_id")))
            .withColumn("policy_id", F.coalesce(named_id, "_holder")).drop("_holder"))
