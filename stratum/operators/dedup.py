"""Deterministic deduplication (DED1).

``dropDuplicates`` keeps an arbitrary row.  Here the survivor per key is the
row with the smallest ordering tuple, computed as ``min(struct(...))`` in a
hash/sort *aggregate*: partial aggregation runs map-side, so a key holding a
third of all rows collapses to one row per map task before the shuffle and
never lands whole on one reducer (a ``row_number`` window would sort the
entire hot key in one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.session import scratch_path
from stratum.sources.files import folder_bytes

REPEATED_BYTES = 32 << 20       # written size up to which the repeated keys are broadcast (8 bytes a key)


def dedup_first(df: DataFrame, keys: Sequence[str],
                order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """Keep one row per ``keys``: the minimum of ``order_by`` (ascending,
    NULLs first), ties broken by the remaining columns so the choice is total.
    """
    payload = [c for c in df.columns if c not in keys]
    fields, named = [], set()
    for i, c in enumerate(order_by or []):
        if isinstance(c, str) and c in payload:
            fields.append(F.col(c))          # ordering column is also payload
            named.add(c)
        else:
            fields.append((F.col(c) if isinstance(c, str) else c).alias(f"__o{i}"))
    fields += [F.col(c) for c in payload if c not in named]
    agg = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("__best"))
    return agg.select(*keys, *[F.col(f"__best.{c}").alias(c) for c in payload]).select(*df.columns)


def dedup_rare(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """``dedup_first`` for wide rows of which few share a key: only those are
    shuffled whole.

    A first pass counts the 64-bit hashes of the keys, 8 bytes a row, and writes
    those that come more than once.  Rows with such a hash (all that share a
    key, and chance collisions) are deduplicated by their keys; the others are
    alone with theirs and stay where they are read.  With more repeated hashes
    than ``REPEATED_BYTES`` hold, all rows take the shuffle.  ``df`` is read three
    times and must give the same rows each time."""
    often = df.select(F.xxhash64(*keys).alias("__h")).groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__h")
    path = scratch_path(df.sparkSession, "repeated_keys")
    often.write.parquet(path)
    if folder_bytes(df.sparkSession, path) > REPEATED_BYTES:
        return dedup_first(df, keys, order_by)
    # a generator of one row: later steps' uses of a column aren't each replaced by its definition
    marked = df.select(F.inline(F.array(F.struct("*", F.xxhash64(*keys).alias("__h")))))
    often = F.broadcast(df.sparkSession.read.parquet(path))
    alone = marked.join(often, "__h", "left_anti").select(*df.columns)
    shared = marked.join(often, "__h", "left_semi").select(*df.columns)
    return alone.unionByName(dedup_first(shared, keys, order_by))


def count_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: input rows, distinct keys, and rows a dedup would drop."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("input_rows"),
                       F.count(F.lit(1)).alias("distinct_keys"),
                       (F.sum("n") - F.count(F.lit(1))).alias("duplicates"))
