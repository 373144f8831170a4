"""Joins: star (size-checked broadcast), as-of, point-in-time, interval
(time-bucketed), aggregate-then-join, and a seeded bridge (JN1-JN11).

Range joins are never expressed as a key-only equi-join with a residual
range predicate (that compares every pair inside a key, and a hot key makes
one task do it all).  As-of / point-in-time lookups are a union plus a
skew-safe carry-forward; interval joins equi-join on time buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from stratum.functions.keys import portable_seed
from stratum.functions.times import epoch_micros, micros_between
from stratum.operators.ordered import fill_forward, time_chunk
from stratum.sources.tables import estimated_bytes

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def small_side(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` only when its estimated size is within ``max_bytes``;
    otherwise the plain frame, left to the shuffle join (AQE still converts
    it at runtime if the measured shuffle output turns out small).

    Without table statistics Spark estimates scans, projections, filters and
    aggregates from file sizes scaled by row width, i.e. an upper bound for
    the dimension-like frames this is applied to."""
    try:
        size = estimated_bytes(df)
    except Exception:  # noqa: BLE001 - no estimate: do not force a broadcast
        return df
    return F.broadcast(df) if size <= max_bytes else df


NULL_KEY_PARTS = 1024       # parts that the rows with a NULL key are dealt to


def left_join_nonnull(fact: DataFrame, dim: DataFrame, keys: Sequence[str],
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Left join that deals fact rows with a NULL key over many tasks.

    NULL keys never match, yet in a shuffle join they all hash to one
    reducer.  A salt joins the keys: for NULL keys a hash of the row, otherwise
    0, which is the salt of every dimension row."""
    keys = list(keys)
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    plain = [f.name for f in fact.schema.fields if not isinstance(f.dataType, MapType)]
    salt = F.when(no_key, F.pmod(F.xxhash64(*plain), F.lit(NULL_KEY_PARTS)) + 1).otherwise(F.lit(0))
    # 0, in a form that the optimizer doesn't fold into a filter beside the join
    zero = F.pmod(F.xxhash64(*keys), F.lit(1))
    return (fact.withColumn("__salt", salt.cast("bigint"))
            .join(small_side(dim.withColumn("__salt", zero), max_bytes), [*keys, "__salt"], "left")
            .drop("__salt"))


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]],
              max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Left-join a fact to each dimension on its key columns: dimensions
    broadcast only when their size is checked small, NULL fact keys dealt
    over many tasks."""
    out = fact
    for dim, keys in dims:
        out = left_join_nonnull(out, dim, keys, max_bytes)
    return out


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str,
              right_ts: str, right_cols: Sequence[str], right_tie: str | None = None,
              tolerance_seconds: int | None = None, chunk_unit: str = "day",
              prefix: str = "r_") -> DataFrame:
    """For every left row: the latest right row of the same key with
    ``right_ts <= left_ts`` (a right row at the same instant counts).

    Union both sides on (key, ts, side) with right sorting first on ties,
    carry right's columns forward with the skew-safe ``fill_forward``, keep
    the left rows.  One shuffle on (key, time chunk); no pair explosion.
    A left row with a NULL key matches nothing, as in any equi-join.
    Optional ``tolerance_seconds`` blanks matches older than the tolerance.
    """
    keys = list(keys)
    carry = [right_ts, *right_cols]
    l_cols = list(left.columns)
    rt = right_tie or right_ts
    tie_type = right.schema[rt].dataType
    r_struct = F.struct(*[F.col(c).alias(c) for c in carry])
    r_type = right.select(r_struct).schema[0].dataType
    l_type = left.select(F.struct(*l_cols)).schema[0].dataType
    # The right row travels as ONE struct: a NULL field (e.g. an open SCD2
    # end) must not be back-filled from an older right row.
    lsel = [*[F.col(k).alias(k) for k in keys], F.col(left_ts).alias("__ts"), F.lit(1).alias("__side"),
            F.lit(None).cast(tie_type).alias("__tie"), F.struct(*l_cols).alias("__l"),
            F.lit(None).cast(r_type).alias("__r")]
    rsel = [*[F.col(k).alias(k) for k in keys], F.col(right_ts).alias("__ts"), F.lit(0).alias("__side"),
            F.col(rt).alias("__tie"), F.lit(None).cast(l_type).alias("__l"), r_struct.alias("__r")]
    u = left.select(*lsel).unionByName(right.select(*rsel))
    filled = fill_forward(u, keys, ["__ts", "__side", "__tie"], time_chunk("__ts", chunk_unit), ["__r"])
    res = filled.where(F.col("__side") == 1)
    fresh = reduce(lambda a, b: a & b, [F.col(f"__l.{k}").isNotNull() for k in keys])
    if tolerance_seconds is not None:
        fresh = fresh & (micros_between(F.col(f"__r.{right_ts}"), F.col("__ts")) <= F.lit(tolerance_seconds * 1_000_000))
    return res.select(*[F.col(f"__l.{c}").alias(c) for c in l_cols],
                      *[F.when(fresh, F.col(f"__r.{c}")).alias(f"{prefix}{c}") for c in carry])


def point_in_time(fact: DataFrame, dim_scd2: DataFrame, keys: Sequence[str], at: str,
                  attrs: Sequence[str], effective_from: str = "effective_from",
                  effective_to: str = "effective_to", chunk_unit: str = "year",
                  prefix: str = "", tie: str | None = None) -> DataFrame:
    """Attach the SCD2 version valid at ``fact.at``:
    ``from <= at < coalesce(to, +inf)``.

    SCD2 versions of a key are contiguous and disjoint, so this is the
    as-of match on ``effective_from``, then a check of ``at < to``.  ``tie``
    orders versions sharing an ``effective_from`` (the later one wins).
    """
    m = asof_join(fact, dim_scd2, keys, at, effective_from, [effective_to, *attrs],
                  right_tie=tie, chunk_unit=chunk_unit, prefix="__v_")
    ok = F.col(f"__v_{effective_from}").isNotNull() & (
        F.col(f"__v_{effective_to}").isNull() | (F.col(at) < F.col(f"__v_{effective_to}")))
    return m.select(*fact.columns,
                    *[F.when(ok, F.col(f"__v_{a}")).alias(f"{prefix}{a}") for a in attrs],
                    F.when(ok, F.col(f"__v_{effective_from}")).alias(f"{prefix}version_from"))


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str,
                  right_ts: str, before_seconds: int, after_seconds: int = 0) -> DataFrame:
    """Pairs with ``left_ts - before <= right_ts <= left_ts + after`` on the
    same key, as an equi-join on (key, time bucket).

    The bucket width equals the window length, so each left row probes the
    few buckets its window overlaps (an ``explode`` of 2-3 bucket ids) and a
    hot key is spread over its time buckets.
    """
    width = before_seconds + after_seconds
    if width <= 0:
        raise ValueError("empty interval")
    keys = list(keys)
    us = F.lit(width * 1_000_000)

    def bucket_of(c: Column) -> Column:
        return F.floor(epoch_micros(c) / us).cast("bigint")

    lo = F.col(left_ts) - F.expr(f"INTERVAL {before_seconds} SECONDS")
    hi = F.col(left_ts) + F.expr(f"INTERVAL {after_seconds} SECONDS")
    lb = left.withColumn("__b", F.explode(F.sequence(bucket_of(lo), bucket_of(hi))))
    rb = right.withColumn("__b", bucket_of(F.col(right_ts)))
    j = lb.alias("l").join(rb.alias("r"), [*keys, "__b"], "inner")
    cond = (F.col(f"r.{right_ts}") >= lo) & (F.col(f"r.{right_ts}") <= hi)
    return j.where(cond).drop("__b")


def aggregate_then_join(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str,
                        aggs: Sequence[Column], how: str = "left") -> DataFrame:
    """One-to-many without fan-out: aggregate the child to the parent grain
    first (map-side combined), then join one row per parent key."""
    per = child.groupBy(F.col(child_key).alias(parent_key)).agg(*aggs)
    return parent.join(per, parent_key, how)


# --------------------------------------------------------------- bridging
RANK_BUCKETS = 4096


def rank_bucket(c) -> Column:
    return F.pmod(portable_seed(c), F.lit(RANK_BUCKETS))


def distributed_rank(df: DataFrame, key: str, out: str = "rank") -> tuple[DataFrame, DataFrame]:
    """Dense 0-based rank of the distinct ``key`` values in the order
    ``(md5 bucket, key)``, without a global single-task sort.

    Per-bucket counts (``RANK_BUCKETS`` rows) give prefix offsets; the rank
    inside a bucket is a window per bucket (distinct keys hash uniformly, so
    buckets are balanced).  Returns (ranked keys, one-row total).
    """
    d = df.select(key).distinct().withColumn("__rb", rank_bucket(key))
    counts = d.groupBy("__rb").agg(F.count(F.lit(1)).alias("__n"))
    from pyspark.sql import Window
    offs = counts.select("__rb", (F.sum("__n").over(Window.orderBy("__rb")) - F.col("__n")).alias("__off"))
    ranked = (d.join(F.broadcast(offs), "__rb")   # at most RANK_BUCKETS rows
               .withColumn(out, (F.col("__off") + F.row_number().over(
                   Window.partitionBy("__rb").orderBy(key)) - 1).cast("bigint"))
               .drop("__rb", "__off"))
    total = counts.agg(F.sum("__n").cast("bigint").alias("__total"))
    return ranked, total


def bridge(left: DataFrame, left_key: str, right: DataFrame, right_key: str,
           out_rank: str = "bridge_rank") -> DataFrame:
    """Deterministic seeded many-to-one mapping of unlinked key spaces:
    ``left_key -> right key ranked at pmod(seed(left_key), n_right)``."""
    ranked, total = distributed_rank(right, right_key, out_rank)
    l = attach_one_row(left.select(left_key).distinct(), total)
    l = l.withColumn(out_rank, F.pmod(portable_seed(left_key), F.col("__total"))).drop("__total")
    return l.join(ranked, out_rank, "left")


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row.  Spark has no
    key to join on, so this is a nested-loop join with a broadcast of exactly
    one row: a row goes in, a row comes out."""
    return df.crossJoin(F.broadcast(one_row))
