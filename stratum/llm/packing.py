"""Packing into token windows (operator 7): minimum bin slack.

A document's tokens (its ids, then the end id) are cut into full windows and a
remainder.  Only remainders need packing.  Their lengths form a histogram of
at most ``window - 1`` counts, whatever the number of documents.  Each step
seeds a window with the longest remaining length and fills the rest by a
subset-sum dynamic program over the bounded counts: bit s of an integer says
that the sum s can be reached, one integer for each length in turn, so that
the multiset closest to capacity is read back from them.  That multiset is
used as often as the counts allow, so a step uses up at least one length class
and the number of steps doesn't grow with the data.

The multisets give a table of slots: the k-th remainder of a length class goes
to a window and an offset found by binary search.  Remainders are numbered
within their class in sub-groups, so a class with a third of all rows is dealt
to many tasks.  The ids move with their pieces; ``sequences`` puts them together.

Defined results: null text is empty and has the end id alone; an added token of
the vocabulary that a text spells out is its one id; every id lies in
exactly one piece; rows that repeat a document (or lack a doc_id) are packed as
often as they occur; very long texts, and long runs of white space or of one
letter, are whole; an empty table gives no piece.  Only doc_id and the text are
read, so other columns, whatever their names, don't matter.  Sequence ids of
windows come before those of full pieces.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.byte_level import encoder, plain_encoder, vocabulary  # noqa: F401
from stratum.llm.common import arrow_map, numbered, pieces
from stratum.sinks import materialize


def added_tokens(path: str) -> dict[str, int]:
    """Content -> id of the added tokens, which ``tokenizers`` finds in the raw
    text before all else."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    tokens = model["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in tokens) or model["normalizer"]:
        raise ValueError("added tokens that depend on the text around them, or a normalizer")
    return {t["content"]: t["id"] for t in tokens if t["content"]}


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Callable[[str], np.ndarray]:
    """Text -> the ids that ``tokenizers`` gives in its default settings (tests
    hold it against them): a text is split at the added tokens, the longest at
    a place, and each stretch between them is encoded on its own."""
    own, added = plain_encoder(path), added_tokens(path)
    if not added:
        return own
    split = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")").split

    def encode(text: str) -> np.ndarray:
        parts = split(text)
        if len(parts) == 1:
            return own(text)
        return np.concatenate([np.array([added[part]], np.uint32) if i % 2 else own(part)
                               for i, part in enumerate(parts)])
    return encode


PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                   ("doc_tokens", pa.int64()), ("ids", pa.binary())])
PIECE_DDL = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"


def id_bytes(path: str, end_id: int) -> int:
    """Bytes that an id takes on its way to its sequence: 2 if all ids fit."""
    most = max([end_id, *vocabulary(path).values(), *added_tokens(path).values()])
    return 2 if most < 1 << 16 else 4


def cut(docs: DataFrame, path: str, window: int, end_id: int = 0, text: str = "text") -> DataFrame:
    """One row per piece with its ids (little-endian unsigned integers of
    ``id_bytes``): full windows and a remainder of each document."""
    width = id_bytes(path, end_id)
    end = np.array([end_id], f"<u{width}").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path)
        for batch in pieces(batches, "text", 1 << 20):
            out: list[tuple] = []
            for doc_id, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(t or "").astype(f"<u{width}").tobytes() + end
                total = len(ids) // width
                for start in range(0, total, window):
                    part = ids[width * start:width * (start + window)]
                    out.append((doc_id, start, len(part) // width, total, part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), PIECE)], schema=PIECE)
    slim = docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string").alias("text"))
    return arrow_map(slim, run, PIECE_DDL)


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, within ``counts``, whose sum is the largest
    that ``capacity`` allows; longer lengths first among equals."""
    mask = (1 << (capacity + 1)) - 1
    lengths = sorted((n for n, c in counts.items() if c and n <= capacity), reverse=True)
    reach, layers = 1, []
    for length in lengths:
        layers.append(reach)
        left, step = min(counts[length], capacity // length), 1
        while left:                              # bounded count in binary parts
            take = min(step, left)
            reach |= (reach << (take * length)) & mask
            left, step = left - take, step * 2
        if reach >> capacity:                    # exactly full: no need to look on
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, before in zip(reversed(lengths[:len(layers)]), reversed(layers)):
        n = 0
        while not (before >> total) & 1:         # fewest of this length that the layer needs
            total -= length
            n += 1
        if n:
            chosen[length] = n
    return chosen


@dataclass(frozen=True)
class Slots:
    """Runs of ranks of a length class: rank ``first`` + q goes to window
    ``window`` + q // per at offset ``offset`` + (q % per) * length."""

    key: np.ndarray         # length << 40 | first rank, sorted
    window: np.ndarray
    per: np.ndarray
    offset: np.ndarray
    windows: int


def plan(histogram: dict[int, int], capacity: int) -> Slots:
    left = {n: c for n, c in histogram.items() if c}
    used = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int]] = []
    windows = 0
    while left:
        seed = max(left)
        rest = {**left, seed: left[seed] - 1}
        chosen = fill(rest, capacity - seed)
        chosen[seed] = chosen.get(seed, 0) + 1
        times = min(left[n] // k for n, k in chosen.items())
        offset = 0
        for length in sorted(chosen, reverse=True):
            k = chosen[length]
            rows.append((length << 40 | used[length], windows, k, offset))
            offset += k * length
            used[length] += k * times
            left[length] -= k * times
            if not left[length]:
                del left[length]
        windows += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 4).T
    return Slots(*columns, windows)


def place(remainders: DataFrame, slots: Slots) -> DataFrame:
    """``remainders`` (with ``rank`` in their length class) with sequence_id and offset."""
    shared = remainders.sparkSession.sparkContext.broadcast(slots)
    schema = PIECE_DDL + ", sequence_id bigint, offset bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            key = (length << 40) | rank
            at = np.searchsorted(s.key, key, side="right") - 1
            q = key - s.key[at]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in PIECE],
                 pa.array(s.window[at] + q // s.per[at]),
                 pa.array(s.offset[at] + q % s.per[at] * length)],
                names=[*PIECE.names, "sequence_id", "offset"])
    return arrow_map(remainders, run, schema)


def widened(packed: DataFrame, width: int) -> DataFrame:
    """``packed`` with ids of ``width`` bytes as unsigned 32-bit integers."""
    if width == 4:
        return packed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide = [np.frombuffer(x, f"<u{width}").astype("<u4").tobytes() for x in batch.column("ids").to_pylist()]
            at = batch.schema.get_field_index("ids")
            yield batch.set_column(at, "ids", pa.array(wide, pa.binary()))
    return arrow_map(packed, run, packed.schema)


def _parts(histogram: dict[int, int], tasks: int) -> Column:
    """Into how many parts a length class is numbered: by its share of all
    remainders, about four parts a task in all."""
    total = max(1, sum(histogram.values()))
    many = {n: 1 + 4 * tasks * c // total for n, c in histogram.items() if 4 * tasks * c >= total}
    if not many:
        return F.lit(1)
    table = F.create_map(*[F.lit(x) for pair in many.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.col("length").cast("int")), F.lit(1))


def pack(docs: DataFrame, path: str, window: int = 1024, end_id: int = 0,
         text: str = "text") -> DataFrame:
    """One row per piece with its ``sequence_id``, ``offset``, ``ids`` and, of
    the ids that arrived there, ``ids_crc32``."""
    all_pieces = materialize(cut(docs, path, window, end_id, text), "packing_pieces")
    rest = all_pieces.where(F.col("length") < window)
    # one count for each length: at most window - 1 rows
    histogram = {r["length"]: r["n"] for r in
                 rest.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = plan(histogram, window)
    order = ["doc_id", "start", "ids"]
    spread = ["doc_id", "start", F.crc32("ids")]
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = place(numbered(rest, "length", order, spread, "rank", _parts(histogram, tasks)), slots)
    full = (numbered(all_pieces.where(F.col("length") == window).withColumn("_all", F.lit(0)),
                     "_all", order, spread, "sequence_id", parts=4096)
            .withColumn("sequence_id", F.col("sequence_id").cast("bigint") + slots.windows)
            .withColumn("offset", F.lit(0).cast("bigint")).drop("_all"))
    return widened(packed.unionByName(full), id_bytes(path, end_id)).withColumn("ids_crc32", F.crc32("ids"))


def sequences(packed: DataFrame, window: int = 1024, pad_id: int = 0) -> DataFrame:
    """The packed sequences themselves, a row each: ``ids`` (packed unsigned
    32-bit integers, padded to ``window``), ``length`` without padding, and the
    pieces in order as ``doc_ids``, ``starts`` and ``lengths``.  A sequence has
    at most ``window`` pieces."""
    in_order = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(
        F.struct("offset", "doc_id", "start", "length", "ids"))).alias("p"))
    joined = F.aggregate("p.ids", F.lit(b""), lambda a, x: F.concat(a, x))
    return in_order.select(
        "sequence_id", F.aggregate("p.length", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("length"),
        F.rpad(joined, F.lit(4 * window), F.lit(pad_id.to_bytes(4, "little"))).alias("ids"),
        F.col("p.doc_id").alias("doc_ids"), F.col("p.start").alias("starts"),
        F.col("p.length").alias("lengths"))
