"""Governance bound to ``customer``, ``orders``, ``nation``, ``region``."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators.governance import column_tags, mask_tagged, mask_value, tag_columns, tenant_filter
from stratum.plans.common import t

MASK_SALT = "stratum-v1"   # binding: token salt (rotate per environment)
# Which tag value gets which strategy.
MASK_POLICY = {"name": "hash", "balance": "band:1000"}
PII_TAGS = {"c_name": {"pii": "name"}, "c_acctbal": {"pii": "balance"},
            "c_phone": {"pii": "phone"}}          # c_phone absent: warns only
PRINCIPAL = "insurer_europe"


def tagged_customers(spark, sf_dir):
    return tag_columns(t(spark, sf_dir, "customer"), PII_TAGS)


def masked_customers(spark, sf_dir):
    """GOV1 + GOV3: tags drive the masks; redact/partial views for display."""
    cust = tagged_customers(spark, sf_dir)
    views = cust.select("*", mask_value(F.col("c_name"), "redact").alias("c_name_redacted"),
                        mask_value(F.col("c_name"), "partial").alias("c_name_partial"))
    return mask_tagged(views, MASK_POLICY, tag="pii", salt=MASK_SALT)


def entitlements(spark, sf_dir):
    """One principal per region, entitled to that region's nations."""
    n, r = t(spark, sf_dir, "nation"), t(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.concat(F.lit("insurer_"), F.lower("r_name")).alias("principal"),
        F.col("n_nationkey").alias("c_nationkey"))


def tenant_orders(spark, sf_dir):
    """GOV4: the orders a principal may see (customer nation entitled)."""
    cust = tenant_filter(t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
                         entitlements(spark, sf_dir), ["c_nationkey"], PRINCIPAL)
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return o.join(cust.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi")


def customer_tags(spark, sf_dir):
    """GOV2: the tags of the tagged table, one row per column and tag."""
    return column_tags(spark, tagged_customers(spark, sf_dir), "customer")
