"""Cross-tokenizer alignment (operator 11).

A text is encoded twice: with a space before it by a byte-level BPE (A), and by
a sentencepiece model (B), which adds that space itself.  Tokens are ranges of
the same bytes.  Where a token of A and one of B end together, both lists can
be cut: the cumulative ends of either list are put into a dictionary from end
to index, the intersection of the keys, sorted, cuts both id lists into groups.
Long texts are intersected a stretch of bytes at a time, which gives the same
ends.  A token has at least one byte, so in a group the pair of last tokens
ends together and no other: that pair is the group's link.

sentencepiece ends a token before a single space, so a text is the sequence of
its segments between spaces, and a segment that occurs often in a batch is
encoded once.

How often an id pair is linked in the whole corpus says how well it fits.  Of
two tokens that end together one's bytes are the end of the other's, so the two
vocabularies bound the number of pairs whatever the corpus (``most_pairs``; 0.5
million for 50 thousand byte-level and 32 thousand sentencepiece ids).  Within
that bound the counts are collected and sent to all tasks.

Defined results: null and empty texts, and texts that either tokenizer doesn't
give back byte by byte (``U+2581`` in a text, for one), have no tokens: counts
are 0 and lists and digest are empty.  Rows that repeat a document are counted
as often as they occur; a null doc_id stays null; an empty table gives no rows.
Only doc_id and the text are read, so other columns, whatever their names,
don't matter.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.byte_level import plain_encoder, vocabulary
from stratum.llm.common import arrow_map, pieces
from stratum.sinks import materialize

TEXT_BYTES = 2 << 20            # text whose tokens a task holds at once
STRETCH = 1 << 20               # bytes of a text whose ends share a dictionary
LONG = 1 << 18                  # characters from which a text is cut for sentencepiece
GROUPS = 1 << 16                # groups that are written out at once
PAIR_LIMIT = 4_000_000          # id pairs that may be collected and broadcast
_CUT = re.compile(r"(?<=[^ ▁]) (?=[^\s▁])")


class ByteLevel:
    """Tokenizer A: a ``tokenizers`` file; special strings are plain text."""

    def __init__(self, path: str):
        ids = vocabulary(path)
        self.bytes_of = [b""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            self.bytes_of[i] = token
        self.size = np.array([len(t) for t in self.bytes_of], np.int64)
        self.encode = plain_encoder(path)


class Pieces:
    """Tokenizer B: a sentencepiece model that puts a space before a text."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [bytes([int(name[3:-1], 16)]) if self.model.is_byte(i)
                         else name.replace("▁", " ").encode() for i, name in enumerate(names)]
        self.size = np.array([len(t) for t in self.bytes_of], np.int64)
        # merges can't cross a single space if no piece holds a space further in
        self.cuttable = not any(" " in name.replace("▁", " ").lstrip(" ") for name in names)

    def encode(self, text: str) -> np.ndarray:
        """The ids; the space that the model adds stands for the one at a cut."""
        if len(text) < LONG or not self.cuttable:
            return np.array(self.model.encode(text), np.uint32)
        return np.array(list(chain.from_iterable(map(self.model.encode, segments(text)))), np.uint32)

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text; a segment that occurs often is encoded once."""
        cut = [segments(t) if self.cuttable else [t] for t in texts]
        distinct = list(dict.fromkeys(chain.from_iterable(cut)))
        known = dict(zip(distinct, self.model.encode(distinct, num_threads=1)))
        for parts in cut:
            yield np.fromiter(chain.from_iterable(map(known.__getitem__, parts)), np.uint32)


def segments(text: str) -> list[str]:
    """``text`` cut at single spaces before which both tokenizers end a token."""
    parts = text.split(" ")
    if all(parts) and "▁" not in text and not any(p[0].isspace() for p in parts[1:]):
        return parts
    return _CUT.split(text)


@lru_cache(maxsize=2)
def byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


@lru_cache(maxsize=2)
def sentence_pieces(path: str) -> Pieces:
    return Pieces(path)


def most_pairs(a: list[bytes], b: list[bytes]) -> int:
    """How many id pairs can end together: one's bytes end the other's."""
    of_a, of_b = Counter(filter(None, a)), Counter(filter(None, b))
    longer_a = sum(n * of_b.get(t[i:], 0) for t, n in of_a.items() for i in range(len(t)))
    longer_b = sum(n * of_a.get(t[i:], 0) for t, n in of_b.items() for i in range(1, len(t)))
    return longer_a + longer_b


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray, stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the tokens of A and of B that end together, in order."""
    if not len(ends_a) or not len(ends_b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    shared = []
    for low in range(0, int(min(ends_a[-1], ends_b[-1])) + 1, stretch):
        (a0, a1), (b0, b1) = (np.searchsorted(e, (low, low + stretch)).tolist() for e in (ends_a, ends_b))
        # both in order, so what they share is, too
        in_a, in_b = (dict.fromkeys(e.tolist()) for e in (ends_a[a0:a1], ends_b[b0:b1]))
        shared.append(np.fromiter(filter(in_a.__contains__, in_b), np.int64))
    ends = np.concatenate(shared)
    # of tokens without bytes the last one that ends there
    return tuple(np.searchsorted(e, ends, "right") - 1 for e in (ends_a, ends_b))


ALIGNED = pa.schema([("doc_id", pa.int64()), ("a_ids", pa.binary()), ("b_ids", pa.binary()),
                     ("a_cuts", pa.binary()), ("b_cuts", pa.binary())])
ALIGNED_DDL = "doc_id bigint, a_ids binary, b_ids binary, a_cuts binary, b_cuts binary"


def align_text(text: str, a: ByteLevel, b: Pieces, ids_b: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Ids of A and of B, and for each group where it ends in either list."""
    none = np.zeros(0, np.uint32)
    if not text:
        return none, none, none, none
    whole = (" " + text).encode()
    ids_a, ids_b = a.encode(" " + text), b.encode(text) if ids_b is None else ids_b
    if any(b"".join(map(own.bytes_of.__getitem__, ids.tolist())) != whole for own, ids in ((a, ids_a), (b, ids_b))):
        return none, none, none, none
    last_a, last_b = common_ends(np.cumsum(a.size[ids_a]), np.cumsum(b.size[ids_b]))
    return ids_a, ids_b, (last_a + 1).astype(np.uint32), (last_b + 1).astype(np.uint32)


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """``doc_id``, both id lists and the groups' ends in them (packed uint32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(a_path), sentence_pieces(b_path)
        for batch in pieces(batches, "text", TEXT_BYTES):
            found = [align_text(t or "", a, b) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([x.astype("<u4").tobytes() for x in column], pa.binary())
                                           for column in zip(*found)]], schema=ALIGNED)

    slim = docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string").alias("text"))
    return arrow_map(slim, run, ALIGNED_DDL)


@lru_cache(maxsize=4)
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0..n-1 as bytes, with a place for a mark behind,
    and how many there are."""
    ids = np.arange(n)
    size = np.searchsorted(10 ** np.arange(1, 11), ids, side="right") + 1
    digits = np.zeros((n, int(size[-1]) + 1), np.uint8)
    for k in range(digits.shape[1] - 1):
        digits[:, k] = 48 + ids // 10 ** np.maximum(size - 1 - k, 0) % 10
    return digits, size


def _written(a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> bytes:
    """``a1,a2|b1;a3|b2,b3;`` of the groups that end at the cuts."""
    place = np.empty(len(a) + len(b), np.int64)
    n_a, n_b = np.diff(a_cuts, prepend=0), np.diff(b_cuts, prepend=0)
    # before a token: the tokens before it in its own list, and the other list's of earlier groups
    place[:len(a)] = np.arange(len(a)) + np.repeat(b_cuts - n_b, n_a)
    place[len(a):] = np.arange(len(b)) + np.repeat(a_cuts, n_b)
    ids, mark = np.empty(len(place), np.int64), np.full(len(place), ord(","), np.uint8)
    ids[place] = np.concatenate((a, b))
    mark[place[a_cuts - 1]], mark[place[len(a) + b_cuts - 1]] = ord("|"), ord(";")
    digits, size = _decimals(1 << int(ids.max()).bit_length() if ids.max() else 2)
    text, size = digits[ids], size[ids]
    text[np.arange(len(ids)), size] = mark
    return text[np.arange(text.shape[1]) <= size[:, None]].tobytes()


def groups_digest(a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> str:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3``; empty without groups."""
    if not len(a_cuts):
        return ""
    digest = hashlib.sha256()
    at_a = at_b = 0
    for low in range(0, len(a_cuts), GROUPS):
        cut_a, cut_b = (c[low:low + GROUPS].astype(np.int64) for c in (a_cuts, b_cuts))
        text = _written(a[at_a:cut_a[-1]], b[at_b:cut_b[-1]], cut_a - at_a, cut_b - at_b)
        digest.update(text if low + GROUPS < len(a_cuts) else text[:-1])
        at_a, at_b = cut_a[-1], cut_b[-1]
    return digest.hexdigest()


LINKED_DDL = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
              "groups_sha256 string, links binary")


LINKED = pa.schema([*[(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")],
                    ("groups_sha256", pa.string()), ("links", pa.binary())])


LINKED = pa.schema([*[(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")],
                    ("groups_sha256", pa.string()), ("links", pa.binary())])


def _aligned_segment(segment: str, ids_a: list[int], ids_b: list[int], a: ByteLevel,
                     b: Pieces) -> tuple[int, int, int, bytes, bytes] | None:
    """Numbers of tokens of A, of B and of groups; the groups written out; the
    links.  None if the tokens don't give the segment back."""
    whole = (" " + segment).encode()
    tokens_a, tokens_b = [a.bytes_of[i] for i in ids_a], [b.bytes_of[i] for i in ids_b]
    if b"".join(tokens_a) != whole or b"".join(tokens_b) != whole:
        return None
    index_a = dict(zip(accumulate(map(len, tokens_a)), range(1, len(ids_a) + 1)))
    index_b = dict(zip(accumulate(map(len, tokens_b)), range(1, len(ids_b) + 1)))
    groups, links_, i, j = [], array("I"), 0, 0
    for end in sorted(index_a.keys() & index_b.keys()):
        x, y = index_a[end], index_b[end]
        groups.append(f"{','.join(map(str, ids_a[i:x]))}|{','.join(map(str, ids_b[j:y]))}")
        links_.extend((ids_a[x - 1], ids_b[y - 1]))
        i, j = x, y
    return len(ids_a), len(ids_b), len(groups), ";".join(groups).encode(), links_.tobytes()


def _aligned_long(segment: str, a: ByteLevel, b: Pieces) -> tuple[int, int, int, bytes, bytes] | None:
    """The same in numpy."""
    ids_a, ids_b, a_cuts, b_cuts = align_text(segment, a, b)
    if not len(a_cuts):
        return None
    cut_a, cut_b = a_cuts.astype(np.int64), b_cuts.astype(np.int64)
    pair = np.column_stack((ids_a[cut_a - 1], ids_b[cut_b - 1])).astype("<u4")
    return len(ids_a), len(ids_b), len(cut_a), _written(ids_a, ids_b, cut_a, cut_b)[:-1], pair.tobytes()


def align_segments(found: list[str], a: ByteLevel, b: Pieces) -> dict[str, tuple | None]:
    """Each of the distinct segments, aligned."""
    short = [s for s in found if len(s) <= SHORT]
    out = {s: _aligned_long(s, a, b) for s in found if len(s) > SHORT}
    for s, ids_b in zip(short, b.model.encode(short, num_threads=1)):
        out[s] = _aligned_segment(s, a.encode(" " + s).tolist(), ids_b, a, b)
    return out


LINKED = pa.schema([*[(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")],
                    ("groups_sha256", pa.string()), ("links", pa.binary())])


def links(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """What ``align`` gives in short, with the links: packed pairs of uint32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(a_path), sentence_pieces(b_path)
        for batch in pieces(batches, "text", TEXT_BYTES):
            out = []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, t, ids_b in zip(batch.column("doc_id").to_pylist(), texts, b.encode_all(texts)):
                ids_a, ids_b, a_cuts, b_cuts = align_text(t, a, b, ids_b)
                pair = np.empty((len(a_cuts), 2), "<u4")
                pair[:, 0] = ids_a[a_cuts.astype(np.int64) - 1]
                pair[:, 1] = ids_b[b_cuts.astype(np.int64) - 1]
                out.append((doc_id, len(ids_a), len(ids_b), len(a_cuts), len(pair),
                            groups_digest(ids_a, ids_b, a_cuts, b_cuts), pair.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), LINKED)], schema=LINKED)

    slim = docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string").alias("text"))
    return arrow_map(slim, run, LINKED_DDL)


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of all rows as integers (A's id << 32 | B's), and the rows' sizes."""
    rows = column.to_pylist()
    pair = np.frombuffer(b"".join(rows), "<u4").reshape(-1, 2).astype(np.int64)
    return pair[:, 0] << 32 | pair[:, 1], np.array([len(r) // 8 for r in rows], np.int64)


def pair_counts(linked: DataFrame) -> DataFrame:
    """``a, b, n``: how many links hold the pair, counted in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            new, times = np.unique(_codes(batch.column("links"))[0], return_counts=True)
            pair, back = np.unique(np.concatenate((pair, new)), return_inverse=True)
            # exact: sums of doubles below 2^53
            n = np.bincount(back, np.concatenate((n, times)), len(pair)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    return (arrow_map(linked.select("links"), run, "pair bigint, n bigint")
            .groupBy("pair").agg(F.sum("n").alias("n"))
            .select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b"), "n"))


RATED_DDL = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
             "count_sum bigint, groups_sha256 string")


def rate(linked: DataFrame, counts: DataFrame) -> DataFrame:
    """``linked`` with ``n_best`` (links whose pair is its B id's commonest) and
    ``count_sum``.  ``counts`` must be within ``PAIR_LIMIT``."""
    table = counts.toPandas()                        # bounded by the vocabularies
    code = (table["a"].to_numpy(np.int64) << 32) | table["b"].to_numpy(np.int64)
    order = np.argsort(code)
    code, n = code[order], table["n"].to_numpy(np.int64)[order]
    b = code & 0xFFFFFFFF
    best = np.zeros(int(b.max()) + 1 if len(b) else 1, np.int64)
    np.maximum.at(best, b, n)
    shared = linked.sparkSession.sparkContext.broadcast((code, n, n == best[b]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, n, is_best = shared.value
        for batch in batches:
            pair, sizes = _codes(batch.column("links"))
            at = np.searchsorted(code, pair)
            sums = [np.diff(np.concatenate(([0], np.cumsum(values[at], dtype=np.int64)))[
                np.concatenate(([0], np.cumsum(sizes)))]) for values in (is_best, n)]
            fields = {name: batch.column(name) for name in batch.schema.names}
            fields["n_best"], fields["count_sum"] = map(pa.array, sums)
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([fields[name] for name in names], names=names)
    return arrow_map(linked, run, RATED_DDL)


def link_quality(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """A row for each of ``docs``: sizes, groups' digest and the links rated."""
    bound = most_pairs(byte_level(a_path).bytes_of, sentence_pieces(b_path).bytes_of)
    if bound > PAIR_LIMIT:
        raise ValueError(f"the vocabularies allow {bound} pairs, more than are broadcast ({PAIR_LIMIT})")
    linked = materialize(links(docs, a_path, b_path, text), "alignment_links")
    return rate(linked, pair_counts(linked))
