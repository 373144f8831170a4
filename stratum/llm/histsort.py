"""Sharding by histogram sort (operator 9, native).

Rows are ordered by a key of 120 bits: 60 of the hash of the text, then 60 of
the hash of doc_id, so equal texts are neighbours and a group of copies larger
than a shard can still be divided.  Splitters are sought for the byte counts
total * j / shards.  Each round probes, for every splitter that is not settled,
the 1,024 boundaries that divide its present key interval evenly, and counts
the exact bytes below them over all partitions; the interval that holds the
target is probed next.  A splitter is settled as soon as a boundary is within
``tolerance`` (a share of a shard) of its target, or when no row is left to
divide the interval.  Then every row is dealt once.

The driver sees (shards - 1) x 1,024 counts a round at most, and there are at
most 12 rounds, whatever the number of rows.

Defined results: a row's size is the UTF-8 bytes of its text (null: none) plus
16.  Rows equal in text and doc_id have one key and stay together.  An empty
table gives no row; with fewer rows than shards, some shards stay empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import numbered, without
from stratum.sinks import materialize

DIGIT, DIGITS, HALF = 10, 12, 60
BASE = 1 << DIGIT
FRAME = 16                  # bytes that a row has besides its text


@dataclass(frozen=True)
class Interval:
    """Keys that begin with ``prefix`` (``depth`` digits); ``below`` bytes
    have smaller keys."""

    prefix: int
    depth: int
    below: int


def _prefix(depth: int) -> Column:
    """The first ``depth`` digits of a row's key, as one string-free number
    where they fit, else as the pair of its halves."""
    if depth * DIGIT <= HALF:
        return F.struct(F.shiftrightunsigned("_h", HALF - depth * DIGIT).alias("h"), F.lit(0).cast("bigint").alias("g"))
    return F.struct(F.col("_h").alias("h"), F.shiftrightunsigned("_g", 2 * HALF - depth * DIGIT).alias("g"))


def _digit(depth: int) -> Column:
    half, at = ("_h", depth) if depth * DIGIT < HALF else ("_g", depth - HALF // DIGIT)
    return F.shiftrightunsigned(half, HALF - (at + 1) * DIGIT).bitwiseAND(F.lit(BASE - 1))


def _halves(prefix: int, depth: int) -> tuple[int, int]:
    bits = depth * DIGIT
    return (prefix, 0) if bits <= HALF else (prefix >> (bits - HALF), prefix & ((1 << (bits - HALF)) - 1))


def splitters(keyed: DataFrame, shards: int, tolerance: float) -> list[tuple[int, int]]:
    """The (hash, id hash) at which shards 1, 2, ... begin, from rows with
    ``_h, _g, size``."""
    total = keyed.agg(F.sum("size").alias("n")).first()["n"] or 0
    targets = {j: total * j // shards for j in range(1, shards)}
    allowed = tolerance * total / shards
    found: dict[int, int] = {}              # splitter -> key of 120 bits
    open_: dict[int, Interval] = {j: Interval(0, 0, 0) for j in targets} if total else {}
    for depth in range(DIGITS):
        if not open_:
            break
        probed = {_halves(i.prefix, depth) for i in open_.values()}
        rows = keyed.withColumn("_p", _prefix(depth))
        if depth:
            one_of = F.array(*[F.struct(F.lit(h).cast("bigint").alias("h"), F.lit(g).cast("bigint").alias("g"))
                               for h, g in sorted(probed)])
            rows = rows.where(F.array_contains(one_of, F.col("_p")))
        counted: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for r in (rows.groupBy("_p", _digit(depth).alias("_d"))
                  .agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()):
            counted.setdefault((r["_p"]["h"], r["_p"]["g"]), []).append((r["_d"], r["size"], r["n"]))
        still: dict[int, Interval] = {}
        for j, interval in open_.items():
            below = interval.below
            for digit, size, n in sorted(counted[_halves(interval.prefix, depth)]):
                if below + size >= targets[j]:
                    break
                below += size
            child = interval.prefix << DIGIT | digit
            under, over = targets[j] - below, below + size - targets[j]
            if min(under, over) <= allowed or n == 1 or depth == DIGITS - 1:
                edge = child if under <= over else child + 1
                found[j] = edge << (2 * HALF - (depth + 1) * DIGIT)
            else:
                still[j] = Interval(child, depth + 1, below)
        open_ = still
    return [(found[j] >> HALF, found[j] & ((1 << HALF) - 1)) for j in sorted(found)]


def shard(docs: DataFrame, shards: int, tolerance: float = 0.0005, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot`` (its place in the shard, gapless from 0)."""
    own = without(docs, ["size", "shard", "slot"])
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = (own.withColumn("size", F.octet_length(body).cast("bigint") + FRAME)
             .withColumn("_h", F.shiftrightunsigned(F.xxhash64(body), 64 - HALF))
             .withColumn("_g", F.shiftrightunsigned(F.xxhash64(F.col(doc_id)), 64 - HALF)))
    probes = materialize(keyed.select("_h", "_g", "size"), "histsort_keys")
    at = splitters(probes, shards, tolerance)
    reached = [((F.col("_h") > h) | ((F.col("_h") == h) & (F.col("_g") >= g))).cast("int") for h, g in at]
    dealt = keyed.withColumn("shard", sum(reached, F.lit(0)).cast("int"))
    order = ["_h", "_g", F.col(doc_id)]
    return numbered(dealt, "shard", order, ["_g"], "slot", parts=256).drop("_h", "_g")


def write(docs: DataFrame, path: str, shards: int, tolerance: float = 0.0005) -> None:
    """Write the shards, texts and all, as folders ``shard=0`` ...; the texts move once."""
    (shard(docs, shards, tolerance).write.partitionBy("shard").parquet(path))
