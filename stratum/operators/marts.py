"""Marts and snapshot facts (AGG4-AGG19).

All measures are computed in one grouped aggregate per mart (partial
aggregation map-side, one shuffle on the grouping keys); shares and lifts
use windows over the *aggregated* rows,
never a window over the raw facts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators.joins import attach_one_row

TERMINAL = ("denied", "closed", "settled")


def _ratio(num: Column, den: Column, digits: int = 6) -> Column:
    return F.round(num.cast("double") / F.when(den != 0, den.cast("double")), digits)


# Upper bounds in days of the aging buckets of open claims.
AGING = (30, 90, 365)


def _aging(open_age: Column) -> list[Column]:
    names = [f"open_{lo + 1 if lo else 0}_{hi}d" for lo, hi in zip((0, *AGING), AGING)]
    within = [(open_age <= hi) & ((open_age > lo) if lo else F.lit(True)) for lo, hi in zip((0, *AGING), AGING)]
    return [F.count_if(w).alias(n) for n, w in zip(names, within)] \
        + [F.count_if(open_age > AGING[-1]).alias(f"open_over_{AGING[-1]}d")]


def claims_kpi(claims: DataFrame, segments: Sequence[str], exposure: DataFrame, as_of: str,
               date_col: str = "incident_date", period: str = "month",
               mix_within: Sequence[str] | None = None) -> DataFrame:
    """KPI mart by segment x period (AGG4a-j).

    ``exposure``: premium and exposures by the segments and ``period``.
    loss ratio = incurred / premium; frequency = claims / exposures;
    severity = incurred / claims with an amount (NULL amounts are not 0);
    claim mix = share of the row's claims within ``mix_within`` x period;
    aging = open claims by days since they were reported, at ``as_of``.
    """
    c = F.col
    amt = c("total_claim_amount")
    open_age = F.when(c("settlement_date").isNull(), F.datediff(F.lit(as_of).cast("date"), c("fnol_date")))
    aging = _aging(open_age)
    g = claims.groupBy(*segments, F.trunc(date_col, period).alias("period")).agg(
        F.count(F.lit(1)).alias("n_claims"),
        F.count(amt).alias("n_with_amount"),
        F.sum(amt).alias("__incurred"),
        F.sum(c("injury_claim")).alias("__inj"), F.sum(c("property_claim")).alias("__prop"),
        F.sum(c("vehicle_claim")).alias("__veh"),
        F.avg(c("fraud").cast("int")).alias("__fraud"),
        F.count_if(c("settlement_date").isNull()).alias("open_claims"),
        F.count_if(c("settlement_date").isNotNull()).alias("closed_claims"),
        F.avg("cycle_time_days").alias("__cycle"),
        F.count_if(c("claim_status") == "denied").alias("__denied"),
        F.count_if(c("claim_status").isin(*TERMINAL)).alias("__terminal"), *aging)
    keys = [*segments, "period"]
    e = exposure.select(*[c(k).alias(f"__{k}") for k in keys], "premium", "exposures")
    # both sides are aggregates; a segment may be NULL
    same = reduce(lambda a, b: a & b, [c(k).eqNullSafe(c(f"__{k}")) for k in keys])
    mix_keys = list(mix_within if mix_within is not None else segments[:1])
    mix = c("n_claims") / F.sum("n_claims").over(Window.partitionBy(*mix_keys, "period"))
    return g.join(e, same, "left").select(
        *keys, "n_claims", "n_with_amount",
        c("__incurred").cast("double").alias("incurred"),
        c("premium").cast("double").alias("premium"), "exposures",
        _ratio(c("__incurred"), c("premium")).alias("loss_ratio"),
        _ratio(c("n_claims"), c("exposures")).alias("claim_frequency"),
        _ratio(c("__incurred"), c("n_with_amount")).alias("severity"),
        F.round(c("__fraud"), 6).alias("fraud_rate"),
        F.round(mix, 6).alias("claim_mix"),
        _ratio(c("__inj"), c("__incurred")).alias("injury_share"),
        _ratio(c("__prop"), c("__incurred")).alias("property_share"),
        _ratio(c("__veh"), c("__incurred")).alias("vehicle_share"),
        F.round(c("__cycle"), 6).alias("avg_cycle_days"),
        "open_claims", "closed_claims", *[n for n in g.columns if n.startswith("open_") and n != "open_claims"],
        _ratio(c("__denied"), c("__terminal")).alias("denial_rate"))


def kpi_rollup(claims: DataFrame, levels: Sequence[Column | str]) -> DataFrame:
    """Subtotals along a hierarchy (ROLLUP) with ``grouping_id``."""
    return claims.rollup(*levels).agg(
        F.grouping_id().alias("gid"),
        F.count(F.lit(1)).alias("n_claims"),
        F.sum("total_claim_amount").cast("double").alias("incurred"),
        F.round(F.avg(F.col("fraud").cast("int")), 6).alias("fraud_rate"))


def fraud_signals(df: DataFrame, dims: Sequence[str], label: str = "is_fraud") -> DataFrame:
    """Fraud rate and lift per value of each dimension (GROUPING SETS),
    in long form: (dimension, value, n_claims, n_fraud, fraud_rate, lift).
    One Expand + one aggregate, whose empty grouping set is the overall rate."""
    dims = list(dims)
    every = (1 << len(dims)) - 1
    g = df.groupingSets([[d] for d in dims] + [[]], *dims).agg(
        F.grouping_id().alias("__gid"),
        F.count(F.lit(1)).alias("n_claims"),
        F.sum(F.col(label).cast("long")).alias("n_fraud"))
    # a set that groups by dimension i alone has every bit but i's
    own = [F.col("__gid") == every - (1 << (len(dims) - 1 - i)) for i in range(len(dims))]
    out = g.where(F.col("__gid") != every).select(
        F.coalesce(*[F.when(o, F.lit(d)) for o, d in zip(own, dims)]).alias("dimension"),
        F.coalesce(*[F.when(o, F.col(d).cast("string")) for o, d in zip(own, dims)]).alias("value"),
        "n_claims", "n_fraud")
    # the empty set is one row: all claims
    total = g.where(F.col("__gid") == every).select(
        (F.col("n_fraud").cast("double") / F.col("n_claims")).alias("__base"))
    rate = F.col("n_fraud") / F.col("n_claims")
    return attach_one_row(out, total).select(
        "dimension", "value", "n_claims", "n_fraud", F.round(rate, 6).alias("fraud_rate"),
        F.round(rate / F.when(F.col("__base") > 0, F.col("__base")), 6).alias("lift"))


def lifecycle_snapshot(history: DataFrame, key: str = "claim_id") -> DataFrame:
    """Accumulating snapshot (AGG7): milestone dates and stage lags per claim,
    pivoted with conditional aggregates (one shuffle on the claim key; a
    claim has at most three history rows)."""
    c = F.col
    g = history.groupBy(key).agg(
        F.min(F.when(c("seq") == 1, c("status_date"))).alias("fnol_date"),
        F.min(F.when(c("seq") == 2, c("status_date"))).alias("review_date"),
        F.max(F.when(c("seq") == 3, c("status"))).alias("final_status"),
        F.max(F.when(c("seq") == 3, c("status_date"))).alias("final_date"),
        F.count(F.lit(1)).alias("n_transitions"))
    return g.select(key, "fnol_date", "review_date", "final_status", "final_date", "n_transitions",
                    F.datediff("review_date", "fnol_date").alias("days_to_review"),
                    F.datediff("final_date", "review_date").alias("days_review_to_final"),
                    F.datediff("final_date", "fnol_date").alias("days_to_final"))


def status_history_fact(history: DataFrame, key: str = "claim_id") -> DataFrame:
    """Row per status change with time in status (AGG8).  The window is per
    claim, whose size is bounded (<= 3 rows), so it cannot skew."""
    w = Window.partitionBy(key).orderBy("seq")
    nxt = F.lead("status_date").over(w)
    return history.select("*", nxt.alias("next_status_date"),
                          F.datediff(nxt, F.col("status_date")).alias("days_in_status"))
