"""Byte-level BPE encoding and decoding (operator 8).

Bytes are mapped to Latin-1 characters, so that one character is one byte and
a pyahocorasick automaton can hold the vocabulary.  A piece (a match of the
split pattern) is encoded by backtracking: take the longest token at each
place; go on if it is compatible with the token before, that is if merging
the bytes of the two gives exactly the two; else try the next shorter token;
when none is left, the place can't begin a token of the result, and the token
before is shortened.  Places found dead are marked, so each is left once.  A
sequence of tokens that are compatible pairwise is the one the merges make.
Compatibility is memoised by pair of tokens; the merges run only on the few
bytes of a new pair.

A text is cut into chunks before each space that is followed by a character
other than white space: the pattern always ends a match there.  A task keeps
the ids of the chunks and pieces it has met lately, in memos of bounded size.

Defined results: null counts as empty; an empty text has no ids and decodes to
no bytes.  A vocabulary must hold all 256 bytes.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

from stratum.llm.common import Recent, arrow_map, chunks, pieces, without

CHUNKS, PIECES, PAIRS = 1 << 18, 1 << 18, 1 << 19      # entries of the memos


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def white_space_by_property(pattern: str) -> str:
    r"""``\s`` and ``\S`` as Unicode's White_Space property."""
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


class Bpe:
    """Encoder and decoder for one vocabulary of ranks and a split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the vocabulary lacks the bytes {missing[:8]}")
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self.split = regex.compile(white_space_by_property(pattern))
        self._compatible: dict[int, bool] = {}
        self._pieces = Recent(self.pack_piece, PIECES)
        self._cache = Recent(self.encode_chunk, CHUNKS)
        # tokens that the merges can make; others occur only as whole pieces
        self.reachable = {rank for token, rank in ranks.items() if self.merge(token) == [rank]}
        self.automaton = ahocorasick.Automaton()
        for rank in self.reachable:
            token = self.bytes_of[rank]
            self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, rank))
        self.automaton.make_automaton()
        self.shorter = {rank: self._next_shorter(self.bytes_of[rank]) for rank in self.reachable}

    def merge(self, piece: bytes) -> list[int]:
        """The merges in order of rank, leftmost first: the definition."""
        ranks, never = self.ranks, 1 << 60
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            pairs = [ranks.get(a + b, never) for a, b in zip(parts, parts[1:])]
            best = min(pairs)
            if best == never:
                break
            at = pairs.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _next_shorter(self, token: bytes) -> int | None:
        for end in range(len(token) - 1, 0, -1):
            rank = self.ranks.get(token[:end])
            if rank in self.reachable:
                return rank
        return None

    def compatible(self, left: int, right: int) -> bool:
        if len(self._compatible) >= PAIRS:
            self._compatible.clear()
        fits = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        self._compatible[left << 32 | right] = fits
        return fits

    def longest(self, latin: str) -> list[int]:
        """The longest token that starts at each place: matches come by their
        end, so a later one at the same place is longer."""
        at = [0] * len(latin)
        for end, (back, rank) in self.automaton.iter(latin):
            at[end - back] = rank
        return at

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of a piece that is not itself a token."""
        n = len(piece)
        first = self.longest(piece.decode("latin-1"))
        alive = bytearray(b"\x01") * (n + 1)      # may a token of the result begin here
        size, shorter, known = self.size, self.shorter, self._compatible
        out: list[int] = []
        place, token, last = 0, first[0], None
        while place < n:
            while token is not None:
                end = place + size[token]
                if alive[end]:
                    if last is None:
                        break
                    fits = known.get(last << 32 | token)
                    if fits or fits is None and self.compatible(last, token):
                        break
                token = shorter[token]
            if token is not None:
                out.append(token)
                place, last = end, token
                token = first[place] if place < n else None
            else:
                alive[place] = 0
                token = out.pop()
                place -= size[token]
                last = out[-1] if out else None
        return out

    def pack_piece(self, piece: str) -> bytes:
        raw = piece.encode()
        rank = self.ranks.get(raw)
        if rank is not None:
            return rank.to_bytes(4, "little")
        got = self.encode_piece(raw)
        return struct.pack(f"<{len(got)}I", *got)

    def encode_chunk(self, chunk: str) -> bytes:
        found = self.split.findall(chunk)
        if len(found) == 1:
            return self._pieces.get(chunk)
        return b"".join(map(self._pieces.get, found))

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self._cache.get, chunks(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Bpe:
    return Bpe(read_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``: little-endian unsigned 32-bit integers, packed."""
    return _mapped(docs, text, "ids", lambda bpe, t: bpe.encode(t or ""), path, pattern)


def decode(coded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``coded`` with ``decoded``: the bytes of the ids."""
    return _mapped(coded, ids, "decoded", lambda bpe, i: bpe.decode(i or b""), path, pattern)


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded``: encoded, then decoded."""
    coded = encode(docs, path, pattern, text)
    return decode(coded.drop(text), path, pattern)


def _mapped(df: DataFrame, column: str, name: str, fn, path: str, pattern: str) -> DataFrame:
    own = without(df, [name])
    schema = StructType([*own.schema.fields, StructField(name, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in pieces(batches, column):
            got = [fn(bpe, x) for x in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.binary())],
                                             names=[*batch.schema.names, name])
    return arrow_map(own, run, schema)
