"""Skew-safe ordered scans within a key: previous/next row, running sums,
last-non-NULL carry (the building blocks of SCD2 closing, sessionization,
as-of joins, monotonic checks and running totals).

A plain ``Window.partitionBy(key).orderBy(ts)`` sorts every row of a key in
one task; a key with a third of all rows would make one task sort a third of
the data.  Here every scan runs in two levels:

1. a window over ``(key, chunk)`` partitions, where ``chunk`` is a coarse,
   order-monotone bucket of the ordering column (a day, a month, a year);
2. a carry between consecutive chunks of a key, computed on the per-chunk
   aggregate (one row per ``(key, chunk)``, map-side combined) and joined back
   on ``(key, chunk)``.

The hot key is thus spread over as many tasks as it has chunks, and the
carry table is tiny compared with the rows.  The join back reuses the
``(key, chunk)`` hash partitioning the window already created; AQE turns it
into a broadcast when the carry table is measured small at runtime.

Contract: ``chunk`` must be non-decreasing along ``order`` within a key and
``order`` should be a total order within the key (ties make any window scan
non-deterministic).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "__chunk"
GROUP = "__group"       # struct of the keys and the chunk: two structs are equal where
                        # their NULL fields agree, so rows with NULL keys (one group for
                        # a window) find the carry of their own group, too


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _of_group(keys):
    return [F.col(f"{GROUP}.`{k}`") for k in keys]


def time_chunk(ts: str | Column, unit: str = "day") -> Column:
    """A chunk expression: ``date_trunc(unit, ts)``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc(unit, c)


def with_chunk(df: DataFrame, keys: Sequence[str], chunk: Column) -> DataFrame:
    df = df if CHUNK in df.columns else df.withColumn(CHUNK, chunk)
    if GROUP in df.columns and df.schema[GROUP].dataType.fieldNames() == [*keys, CHUNK]:
        return df
    return df.withColumn(GROUP, F.struct(*[F.col(k) for k in [*keys, CHUNK]]))


def neighbour(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              chunk: Column, carry: Sequence[str], direction: str = "prev",
              prefix: str | None = None, keep_chunk: bool = False) -> DataFrame:
    """Add ``{prefix}{c}`` = value of ``c`` on the previous (or next) row of
    the same key, for every ``c`` in ``carry``; NULL at the key's edge."""
    if direction not in ("prev", "next"):
        raise ValueError(direction)
    prefix = prefix if prefix is not None else f"{direction}_"
    keys = list(keys)
    df = with_chunk(df, keys, chunk)
    ordc = _cols(order)
    payload = F.struct(*[F.col(c).alias(c) for c in carry])
    w_in = Window.partitionBy(GROUP).orderBy(*ordc)
    step = F.lag if direction == "prev" else F.lead
    inner = df.withColumn("__in", step(payload).over(w_in))

    # chunk edge: last row of each chunk (for prev) / first row (for next)
    edge_struct = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(ordc)],
                           *[F.col(c).alias(c) for c in carry])
    edge = F.max(edge_struct) if direction == "prev" else F.min(edge_struct)
    per_chunk = df.groupBy(GROUP).agg(edge.alias("__edge"))
    w_chunks = Window.partitionBy(*_of_group(keys)).orderBy(f"{GROUP}.{CHUNK}")
    per_chunk = per_chunk.select(
        GROUP,
        step(F.struct(*[F.col(f"__edge.{c}").alias(c) for c in carry])).over(w_chunks).alias("__carry"))

    joined = inner.join(per_chunk, GROUP, "left")
    out = joined.select(
        *[F.col(c) for c in df.columns],
        *[F.when(F.col("__in").isNull(), F.col(f"__carry.{c}"))
           .otherwise(F.col(f"__in.{c}")).alias(f"{prefix}{c}") for c in carry])
    return out if keep_chunk else out.drop(CHUNK, GROUP)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                chunk: Column, value: str | Column, out: str,
                keep_chunk: bool = False) -> DataFrame:
    """Inclusive running sum of ``value`` within the key, in ``order``."""
    keys = list(keys)
    df = with_chunk(df, keys, chunk)
    v = F.col(value) if isinstance(value, str) else value
    df = df.withColumn("__v", v)
    w_in = (Window.partitionBy(GROUP).orderBy(*_cols(order))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = df.withColumn("__in", F.sum("__v").over(w_in))
    w_before = (Window.partitionBy(*_of_group(keys)).orderBy(f"{GROUP}.{CHUNK}")
                .rowsBetween(Window.unboundedPreceding, -1))
    per_chunk = (df.groupBy(GROUP).agg(F.sum("__v").alias("__tot"))
                   .select(GROUP, F.sum("__tot").over(w_before).alias("__off")))
    joined = inner.join(per_chunk, GROUP, "left")
    res = joined.select(*[F.col(c) for c in df.columns if c != "__v"],
                        (F.col("__in") + F.coalesce(F.col("__off"), F.lit(0))).alias(out))
    return res if keep_chunk else res.drop(CHUNK, GROUP)


def fill_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                 chunk: Column, cols: Sequence[str], prefix: str = "",
                 keep_chunk: bool = False) -> DataFrame:
    """For each ``c`` in ``cols``: the last non-NULL value of ``c`` at or
    before the row (within the key), written to ``{prefix}{c}``."""
    keys = list(keys)
    df = with_chunk(df, keys, chunk)
    ordc = _cols(order)
    w_in = (Window.partitionBy(GROUP).orderBy(*ordc)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = df.select(*[F.col(c) for c in df.columns],
                      *[F.last(c, ignorenulls=True).over(w_in).alias(f"__in_{c}") for c in cols])
    ordkey = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(ordc)])
    last_nn = [F.max(F.when(F.col(c).isNotNull(), F.struct(ordkey.alias("k"), F.col(c).alias("v"))))
                .alias(f"__l_{c}") for c in cols]
    w_before = (Window.partitionBy(*_of_group(keys)).orderBy(f"{GROUP}.{CHUNK}")
                .rowsBetween(Window.unboundedPreceding, -1))
    per_chunk = (df.groupBy(GROUP).agg(*last_nn)
                   .select(GROUP, *[F.last(F.col(f"__l_{c}.v"), ignorenulls=True)
                                             .over(w_before).alias(f"__c_{c}") for c in cols]))
    joined = inner.join(per_chunk, GROUP, "left")
    res = joined.select(
        *[F.col(c) for c in df.columns if not (prefix == "" and c in cols)],
        *[F.coalesce(F.col(f"__in_{c}"), F.col(f"__c_{c}")).alias(f"{prefix}{c}") for c in cols])
    return res if keep_chunk else res.drop(CHUNK, GROUP)
