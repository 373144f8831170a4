"""Mergeable sketches: quantiles (KLL, AGG4c) and distinct counts (HLL, AGG3).

A sketch of a group is small whatever the group's size; sketches of parts merge
into the sketch of the whole, so they are stored at the finest level (a segment
and month, a day) and rolled up without the rows.  Their states are aggregate
buffers: tasks combine their rows before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUANTILE_K = 800
DISTINCT_LG_K = 12


def rank_error(k: int = QUANTILE_K) -> float:
    """The published bound of a KLL sketch: with 99 % confidence the rank of a
    quantile it gives is off by at most this share.  Up to ``k`` values are kept
    whole, and then it is exact."""
    return 2.296 / k ** 0.9723


def distinct_error(lg_k: int = DISTINCT_LG_K) -> float:
    """One standard error of an HLL estimate, as a share."""
    return 1.04 / 2 ** (lg_k / 2)


def quantile_sketches(df: DataFrame, keys: Sequence[str | Column], value: str, k: int = QUANTILE_K) -> DataFrame:
    """``keys, sketch, n``: a KLL sketch of the group's values that aren't NULL."""
    x = F.col(value).cast("double")
    return df.where(x.isNotNull()).groupBy(*keys).agg(
        F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("n"))


def merge_quantiles(sketches: DataFrame, keys: Sequence[str | Column], k: int = QUANTILE_K) -> DataFrame:
    """Roll sketches up to ``keys``."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
                                       F.sum("n").alias("n"))


def quantile(p: float, sketch: str = "sketch") -> Column:
    return F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(float(p)))


def distinct_sketches(df: DataFrame, keys: Sequence[str | Column], value: str, lg_k: int = DISTINCT_LG_K) -> DataFrame:
    """``keys, sketch``: an HLL sketch of the group's values that aren't NULL."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(value), F.lit(lg_k)).alias("sketch"))


def merge_distinct(sketches: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimate(sketch: str = "sketch") -> Column:
    return F.hll_sketch_estimate(F.col(sketch))
