"""Target-distribution importance resampling (operator 12).

Features are all runs of 1 to ``longest`` consecutive words, repeats counted,
in ``buckets`` hashed buckets.  The corpus and the target texts are counted;
a bucket's gain is the floored log ratio of its smoothed shares, a document's
weight the sum of its features' gains, and its score the weight plus Gumbel
noise from its doc_id.  The highest scores among documents of ``min_words``
words or more are drawn.

In a task, words are found in the bytes of many documents at once.  The runs of
up to ``WORDS`` words are interned in an open-addressed table of numpy arrays:
the xxhash64 of a run's bytes gives its first slot, a slot is taken by a run or
compared with it byte by byte, and runs that differ from what they find go on
to the next slot, all runs at a time.  Short runs are hashed at once in numpy.  A slot stores its bucket (one crc32 for
each distinct run) and its count.  Counting adds the slots up by bucket;
weighing gathers gains by the slots of the runs' occurrences.

The corpus is read twice, as no document's weight is known before all are
counted.  A task hands over at most ``buckets`` counts, the driver gets and
sends as many.  Ranks come from a range partitioning by score.

Defined results: null and empty texts have no features, weight 0, and aren't
drawn; a null doc_id draws its noise as ``null`` and ranks behind others of its
score; rows that repeat a document are counted and drawn as often as they
occur (equal rows have consecutive ranks); a long text is worked off in runs of
``WORDS`` words; an empty table gives no rows, empty targets an even one.  Only
doc_id and the text are read, so other columns, whatever their names, don't
matter.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import arrow_map, pieces, utf8
from stratum.sinks import materialize

WORDS = 1 << 16                 # words whose runs share a table
TEXT_BYTES = 1 << 20            # text that a task holds as arrays

# fixed values: word characters as bytes (0-9, a-z, all beyond ASCII); A-Z are lower-cased
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


@dataclass(frozen=True)
class ResamplingConfig:
    longest: int = 3            # words in a run
    buckets: int = 10_000
    percent: int = 5            # share of the eligible documents that is drawn
    min_words: int = 20
    seed: int = 42


class Words:
    """Words of many texts: ``buffer`` has each followed by one space, ``start``,
    ``end`` are their places there, ``text`` is the number of their text."""

    def __init__(self, raw: np.ndarray, at: np.ndarray):
        n = len(at) - 1
        spaced = np.insert(_LOWER[raw], at[1:], 32)        # a space behind each text
        inside = _WORD[spaced]
        edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
        first, after = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        inside[after] = True
        spaced[after] = 32
        self.buffer = spaced[inside]
        size = after - first
        self.end = np.cumsum(size + 1) - 1
        self.start = self.end - size
        self.text = np.searchsorted(at[1:] + np.arange(1, n + 1), first, side="right")

    def __len__(self) -> int:
        return len(self.start)

    def runs(self, begin: int, stop: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of all runs that begin at words begin..stop."""
        found = []
        for more in range(longest):
            i = np.arange(begin, min(stop, len(self) - more))
            i = i[self.text[i + more] == self.text[i]]
            found.append((self.start[i], self.end[i + more], self.text[i]))
        return tuple(np.concatenate(x) for x in zip(*found))


def _crc_tables() -> np.ndarray:
    """The CRC-32 of each byte, and of each byte with one to three zeros behind."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = np.where(first & 1, np.uint32(0xEDB88320) ^ (first >> 1), first >> 1).astype(np.uint32)
    out = [first]
    for _ in range(3):
        out.append((out[-1] >> 8) ^ first[out[-1] & 0xFF])
    return np.array(out)


_CRC = _crc_tables()
# fixed values: the primes of xxhash64
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def xxhash64(eight: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of many byte runs of under 32 bytes; ``eight`` gives
    the 8 bytes from each place on."""
    h = size.astype(np.uint64) + _P5
    for lane in range(3):
        i = np.flatnonzero(size >= 8 * (lane + 1))
        k = _turn(eight[start[i] + 8 * lane] * _P2, 31) * _P1
        h[i] = _turn(h[i] ^ k, 27) * _P1 + _P4
    at = start + (size & ~7)
    i = np.flatnonzero(size & 4)
    h[i] = _turn(h[i] ^ ((eight[at[i]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    at += size & 4
    rest = eight[at]
    for byte in range(3):
        i = np.flatnonzero((size & 3) > byte)
        h[i] = _turn(h[i] ^ ((rest[i] >> np.uint64(8 * byte) & np.uint64(0xFF)) * _P5), 11) * _P1
    h ^= h >> np.uint64(33)
    h *= _P2
    h ^= h >> np.uint64(29)
    h *= _P3
    return h ^ (h >> np.uint64(32))


def crc32(eight: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of many byte runs, four bytes at a time; meant for short ones."""
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    c = np.full(len(start), 0xFFFFFFFF, np.uint32)
    for done in range(0, int(size[0]) if len(size) else 0, 4):
        n = int(np.searchsorted(-size, -(done + 4), side="right"))      # runs with four bytes left
        x = c[:n] ^ eight[start[:n] + done].astype(np.uint32)
        c[:n] = _CRC[3][x & 0xFF] ^ _CRC[2][(x >> 8) & 0xFF] ^ _CRC[1][(x >> 16) & 0xFF] ^ _CRC[0][x >> 24]
    rest = eight[start + (size & ~3)].astype(np.uint32)
    for byte in range(3):
        i = np.flatnonzero((size & 3) > byte)
        c[i] = _CRC[0][(c[i] ^ (rest[i] >> (8 * byte))) & 0xFF] ^ (c[i] >> 8)
    out = np.empty(len(c), np.uint32)
    out[order] = ~c
    return out


SHORT_HASH, SHORT_CRC = 32, 128     # bytes under which runs are hashed all at once


class Table:
    """Open-addressed table of byte runs of one buffer."""

    def __init__(self, buffer: np.ndarray, buckets: int, most: int):
        self.buckets = buckets
        self.raw = memoryview(buffer)
        padded = np.concatenate((buffer, np.zeros(16, np.uint8)))
        # the 8 bytes from each place on
        self.eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        slots = 1 << max(4, (2 * most).bit_length())
        self.mask = slots - 1
        self.key = np.zeros(slots, np.uint64)
        self.start = np.full(slots, -1, np.int64)           # -1: free
        self.end = np.zeros(slots, np.int64)
        self.bucket = np.zeros(slots, np.int32)
        self.count = np.zeros(slots, np.int64)
        self._owner = np.zeros(slots, np.int64)

    def _each(self, start: np.ndarray, end: np.ndarray, short: int, many: Callable, one: Callable) -> np.ndarray:
        """A hash of each run: of those under ``short`` bytes at once, of the others one by one."""
        size = end - start
        out = np.empty(len(start), np.uint64)
        few = size < short
        out[few] = many(self.eight, start[few], size[few])
        for i in np.flatnonzero(~few).tolist():
            out[i] = one(self.raw[start[i]:end[i]])
        return out

    def _equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the ``size`` bytes from a and from b on are the same."""
        same = np.ones(len(a), bool)
        todo = np.flatnonzero(a != b)
        done = 0
        while len(todo):
            left = np.minimum(size[todo] - done, 8).astype(np.uint64)
            differ = self.eight[a[todo] + done] ^ self.eight[b[todo] + done]
            bad = (differ << (np.uint64(64) - np.uint64(8) * left)) != 0
            same[todo[bad]] = False
            done += 8
            todo = todo[~bad & (size[todo] > done)]
        return same

    def intern(self, start: np.ndarray, end: np.ndarray, key: np.ndarray | None = None) -> np.ndarray:
        """The slot of each run (at most ``most`` of them in all)."""
        if key is None:
            key = self._each(start, end, SHORT_HASH, xxhash64, xxhash.xxh64_intdigest)
        at = (key & np.uint64(self.mask)).astype(np.int64)
        slot = np.empty(len(start), np.int64)
        taken = []
        todo = np.arange(len(start))
        while len(todo):
            place = at[todo]
            free = self.start[place] < 0
            if free.any():
                claim, wanted = todo[free], place[free]
                self._owner[wanted] = claim                 # of several, one gets the slot
                won = claim[self._owner[wanted] == claim]
                got = at[won]
                self.key[got], self.start[got], self.end[got] = key[won], start[won], end[won]
                taken.append(got)
            size = end[todo] - start[todo]
            match = (self.key[place] == key[todo]) & (self.end[place] - self.start[place] == size)
            hit = np.flatnonzero(match)
            match[hit] = self._equal(start[todo[hit]], self.start[place[hit]], size[hit])
            slot[todo[match]] = place[match]
            todo = todo[~match]
            at[todo] = (at[todo] + 1) & self.mask
        if taken:
            new = np.concatenate(taken)
            self.bucket[new] = self._each(self.start[new], self.end[new], SHORT_CRC, crc32, zlib.crc32) \
                % np.uint64(self.buckets)
        np.add.at(self.count, slot, 1)
        return slot


def _tables(words: Words, config: ResamplingConfig) -> Iterator[tuple[Table, np.ndarray, np.ndarray]]:
    """A table for each ``WORDS`` words, with the slots and texts of the runs."""
    for begin in range(0, len(words), WORDS):
        start, end, text = words.runs(begin, min(begin + WORDS, len(words)), config.longest)
        low, high = int(start.min()), int(end.max())
        table = Table(words.buffer[low:high], config.buckets, len(start))
        yield table, table.intern(start - low, end - low), text


def bucket_counts(docs: DataFrame, config: ResamplingConfig, text: str = "text") -> np.ndarray:
    """How many features of all texts lie in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(config.buckets, np.int64)
        for batch in pieces(batches, "text", TEXT_BYTES):
            for table, _, _ in _tables(Words(*utf8(batch.column("text"))), config):
                np.add.at(total, table.bucket, table.count)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    sums = arrow_map(docs.select(F.col(text).cast("string").alias("text")), run, "bucket bigint, n bigint") \
        .groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(config.buckets, np.int64)
    for row in sums.collect():                              # at most a row for each bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored log ratio (in thousandths) of each bucket's smoothed shares."""
    k = len(corpus)
    s_all, t_all = float(corpus.sum() + k), float(target.sum() + k)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Floored Gumbel noise (in thousandths) of a document."""
    name = f"{seed}:{'null' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCORED = "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint"


def weigh(docs: DataFrame, gain: np.ndarray, config: ResamplingConfig, text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", TEXT_BYTES):
            n = batch.num_rows
            words = Words(*utf8(batch.column("text")))
            features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for table, slot, owner in _tables(words, config):
                np.add.at(weight, owner, gain[table.bucket[slot]])
                features += np.bincount(owner, minlength=n)
            ids = batch.column("doc_id").to_pylist()
            score = weight + np.array([noise(i, config.seed) for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.bincount(words.text, minlength=n).astype(np.int64)),
                 pa.array(features), pa.array(weight), pa.array(score)],
                names=["doc_id", "n_words", "n_features", "weight", "score"])

    slim = docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string").alias("text"))
    return arrow_map(slim, run, SCORED)


def draw(scored: DataFrame, config: ResamplingConfig) -> DataFrame:
    """``scored`` with ``rank`` (from 1) for those drawn.

    The rows are dealt by ranges of the order, sorted, and written with their
    number in their part; the parts' sizes give their first ranks."""
    eligible = F.col("n_words") >= config.min_words
    n = scored.where(eligible).count()
    order = [F.col("_out"), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_tie")]
    dealt = materialize(
        scored.withColumn("_out", ~eligible).withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33))
        .withColumn("_at", F.col("_id").bitwiseAND((1 << 33) - 1))
        .drop("_id", "_tie"), "resampling_order")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each part of the shuffle
    firsts = dealt.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    rank = F.col("_first") + F.col("_at") + 1
    drawn = ~F.col("_out") & (rank <= n * config.percent // 100)
    return dealt.join(F.broadcast(firsts), "_part").withColumn("rank", F.when(drawn, rank)) \
        .drop("_part", "_first", "_at", "_out")


def resample(docs: DataFrame, target: DataFrame, config: ResamplingConfig = ResamplingConfig(),
             text: str = "text", target_text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of each row of
    ``docs``; ``rank`` is null where a document isn't drawn."""
    gain = gains(bucket_counts(docs, config, text), bucket_counts(target, config, target_text))
    return draw(materialize(weigh(docs, gain, config, text), "resampling_scores"), config)
