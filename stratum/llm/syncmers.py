"""Document fingerprints by closed syncmers (operator 2).

A k-mer of code points is an anchor if the smallest of its s-mers (by hash) is
its first or its last.  Whether it is depends on its own characters alone, so
equal passages have equal anchors wherever they stand.  A fingerprint holds all
anchors of its text (about 2 in k - s + 1 places), each with the place where it
first occurs, so that which of a passage's anchors it holds doesn't depend on
the rest of the text, and they can be matched by position.

The likeness of two fingerprints is the Jaccard similarity of the anchor sets,
counting only matches that keep their order: of all anchors of both, the share
that lie in both and on a longest chain of rising positions.

The next document (descending doc_id) is found by one exchange of the texts:
documents are dealt into ranges of doc_id, and the first document of each range
is also sent to the range that precedes it in that order.  A task then walks
its sorted range with one document in hand.

Defined results: null text is empty; a text shorter than k is one anchor; the
empty text has the empty fingerprint, which is like itself only.  A null doc_id
counts as the smallest; rows that share a doc_id follow by text.  A single
document is its own next.  No rows give no rows.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import PIECE_BYTES, arrow_map, pieces

LOWEST = -(1 << 63)


@dataclass(frozen=True)
class SyncmerConfig:
    k: int = 16
    s: int = 8
    size: int = 64      # bounds nothing: a fingerprint holds all anchors


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits, in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BASE = 0x9E3779B97F4A7C15


def _windows(values: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hashes of all windows of ``n`` values, by doubling."""
    out, have, power = values, 1, _BASE
    result, done, shift = None, 0, 0
    while n:
        if n & 1:
            part = out[shift:]
            if result is None:
                result = part.copy()
            else:
                m = len(part)
                result = result[:m] * np.uint64(power) + part
            shift += have
        n >>= 1
        if n:
            m = len(out) - have
            out = out[:m] * np.uint64(power) + out[have:]
            power = power * power & 0xFFFFFFFFFFFFFFFF
            have *= 2
    return result


def anchors(points: np.ndarray, config: SyncmerConfig) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of a text's closed syncmers, in text order."""
    n, k, s = len(points), config.k, config.s
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    values = _mix(points.astype(np.uint64) + np.uint64(1))
    if n < k:
        return _mix(_windows(values, n)), np.zeros(1, np.int64)
    small = _mix(_windows(values, s))
    span = k - s + 1                        # s-mers in a k-mer
    lowest, width = small, 1
    while width * 2 <= span:
        lowest = np.minimum(lowest[:-width], lowest[width:])
        width *= 2
    if width < span:
        lowest = np.minimum(lowest[:len(small) - span + 1], lowest[span - width:])
    places = np.flatnonzero((small[:len(lowest)] == lowest) | (small[span - 1:] == lowest))
    return _mix(_windows(values, k)[places]), places


class Fingerprint:
    """All anchors of a text, by hash (its upper 32 bits)."""

    __slots__ = ("hashes", "places")

    def __init__(self, hashes: np.ndarray, places: np.ndarray):
        self.hashes, self.places = hashes, places

    @classmethod
    def of(cls, points: np.ndarray, config: SyncmerConfig) -> Fingerprint:
        hashes, places = anchors(points, config)
        hashes = (hashes >> np.uint64(32)).astype(np.uint32)
        unique, first = np.unique(hashes, return_index=True)
        return cls(unique, places[first].astype(np.uint32))

    def text(self) -> str:
        both = np.column_stack((self.hashes, self.places)).astype("<u4")
        return base64.b64encode(both.tobytes()).decode()

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        both = np.frombuffer(base64.b64decode(text), "<u4").reshape(-1, 2)
        return cls(both[:, 0], both[:, 1])


def likeness(a: Fingerprint, b: Fingerprint, size: int | None = None) -> float:
    """Ordered Jaccard similarity over all anchors; ``size`` bounds nothing."""
    if not len(a.hashes) or not len(b.hashes):
        return float(len(a.hashes) == len(b.hashes))
    common, in_a, in_b = np.intersect1d(a.hashes, b.hashes, assume_unique=True, return_indices=True)
    union = len(a.hashes) + len(b.hashes) - len(common)
    matched = b.places[in_b[np.argsort(a.places[in_a], kind="stable")]]
    if (matched[1:] > matched[:-1]).all():
        return len(matched) / union
    chain: list[int] = []                   # ends of the best chains by length
    for place in matched.tolist():
        at = bisect_left(chain, place)
        chain[at:at + 1] = [place]
    return len(chain) / union


def ranges(docs: DataFrame, parts: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, _copy`` in partitions by range of doc_id, each sorted
    descending; the first row of the range that follows comes last, as a copy."""
    spark = docs.sparkSession
    key = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LOWEST))
    slim = docs.select(key.alias("_key"), F.col(doc_id).cast("bigint").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    # parts - 1 splitters and parts range heads come to the driver
    shares = [i / parts for i in range(1, parts)] or [0.5]
    got = slim.agg(F.percentile_approx("_key", shares, 10_000).alias("at")).first()["at"] or []
    splitters = np.unique(np.array(got if parts > 1 else [], np.int64))

    @F.pandas_udf("int")
    def range_of(k):
        import pandas as pd
        return pd.Series(np.searchsorted(splitters, k.to_numpy(), side="left").astype(np.int32))

    heads = {r["_part"]: r["head"] for r in
             slim.select("_key").withColumn("_part", range_of("_key"))
             .groupBy("_part").agg(F.max("_key").alias("head")).collect()}
    order = sorted(heads)                   # ascending ranges that have rows
    # the head of each range goes to the range above it, the topmost head to the lowest range
    goes = {heads[p]: order[(i + 1) % len(order)] for i, p in enumerate(order)}
    head_keys = np.array(sorted(goes), np.int64)
    head_to = np.array([goes[h] for h in sorted(goes)], np.int32)

    @F.pandas_udf("array<int>")
    def targets(k):
        import pandas as pd
        values = k.to_numpy()
        own = np.searchsorted(splitters, values, side="left")
        at = np.minimum(np.searchsorted(head_keys, values), max(len(head_keys) - 1, 0))
        is_head = head_keys[at] == values if len(head_keys) else np.zeros(len(values), bool)
        return pd.Series([[int(o), int(head_to[a])] if h else [int(o)]
                          for o, a, h in zip(own, at, is_head)])

    dealt = (slim.withColumn("_to", targets("_key"))
             .select("_key", "doc_id", "text", F.posexplode("_to").alias("_copy", "_part")))
    return (dealt.repartitionById(len(splitters) + 1, F.col("_part"))
            .sortWithinPartitions("_copy", F.desc("_key"), "text")
            .select("doc_id", "text", "_copy"))


RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64())])
RESULT_DDL = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def compare(docs: DataFrame, config: SyncmerConfig = SyncmerConfig(), parts: int | None = None) -> DataFrame:
    """Fingerprints of each document and of its edited text (the last half
    replaced by the start of the next document), and their likenesses."""
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def rows(batches):
        for batch in pieces(batches, "text"):
            yield from zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(),
                           batch.column("_copy").to_pylist())

    def judged(doc, following):
        doc_id, text, own = doc
        _, next_text, next_own = following
        half = len(text) // 2
        edited = text[:len(text) - half] + next_text[:half]
        changed = Fingerprint.of(_points(edited), config)
        return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.text(), changed.text(),
                1.0 if edited == text else likeness(own, changed),
                1.0 if next_text == text else likeness(own, next_own))

    def pairs(batches):
        held = None
        for doc_id, text, copy in rows(batches):
            text = text or ""
            doc = (doc_id, text, Fingerprint.of(_points(text), config))
            if held is not None:
                yield judged(held, doc)
            if copy:
                return              # the last document of the range has met its next
            held = doc

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = 0
        found = pairs(batches)
        for row in found:
            out.append(row)
            held += len(row[3]) + len(row[4])
            if len(out) == 1000 or held > PIECE_BYTES:
                yield _batch(out)
                out, held = [], 0
        if out:
            yield _batch(out)
        for _ in batches:           # copies of rows that share the head's doc_id
            pass
    return arrow_map(ranges(docs, parts), run, RESULT_DDL)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RESULT)],
                                      schema=RESULT)
