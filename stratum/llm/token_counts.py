"""Token counts without ids (operator 13).

A text is cut at the vocabulary's added tokens, normalised and pre-tokenised.
The number of pieces of a pre-token depends on it alone, so it is counted once:
a task takes a block of texts (``PIECE_BYTES``; one text at least) and makes

- the block's distinct pre-tokens, each counted once by the library's model;
- the frequencies: rows (document, pre-token, times);
- their join by the number of the pre-token, summed by document.

No ids are made.  Pre-tokens are found a stretch between white space at a time,
once for each distinct stretch of a block.  Stretches of printable ASCII and
Latin-1 letters, which normalisation only lower-cases, are cut here by the
file's own pattern; all others by the ``tokenizers`` library.

The join is one of a block, not of the whole corpus: there it would send every
distinct pre-token of every block through a shuffle and back, which took 3.7
times the input of disk and more CPU than counting a block's pre-tokens anew.

Defined results: null text is empty and has no tokens; an added token that a
text spells out is one token, as the library has it by default; rows that
repeat a document (or lack a doc_id) are counted as often as they occur; a long
text is taken in parts cut at white space; an empty table gives no rows.  Only
doc_id and the text are read, so other columns, whatever their names, don't
matter.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratum.llm.byte_level import byte_of_character
from stratum.llm.common import PIECE_BYTES, arrow_map, pieces, utf8

_STRETCH = re.compile(r"[^ \t\n\r]+")
_GAP = re.compile(r"[ \t\n\r]")
_SIMPLE = re.compile(r"[!-~À-ÿ]+")             # composed already; lower case one by one


class PreTokens:
    """What the ``tokenizers`` file at ``path`` does before its model."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        added = file["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens that depend on the text around them")
        contents = sorted((t["content"] for t in added if t["content"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, contents))) if contents else None
        own = Tokenizer.from_file(path)
        self.normal, self.cut = own.normalizer, own.pre_tokenizer
        if self.library("aB  c\t\nd .") != list(chain(*map(self.library, ("aB", "c", "d", ".")))):
            raise ValueError("pre-tokens of this vocabulary reach across white space")
        self.split = self._split(file)
        self.shown = str.maketrans({b: c for c, b in byte_of_character().items()})

    @staticmethod
    def _split(file: dict):
        """The pattern, if the file lower-cases, keeps its matches and shows bytes."""
        normal, cut = file["normalizer"] or {}, file["pre_tokenizer"] or {}
        steps, cuts = normal.get("normalizers", []), cut.get("pretokenizers", [])
        if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or steps[1]["pattern"] != {"Regex": r"\s+"} \
                or [c["type"] for c in cuts] != ["Split", "ByteLevel"] \
                or (cuts[0]["behavior"], cuts[0]["invert"]) != ("Removed", True) \
                or cuts[1]["use_regex"] or cuts[1]["add_prefix_space"]:
            return None
        return regex.compile(cuts[0]["pattern"]["Regex"]).findall

    def library(self, text: str) -> list[str]:
        if self.normal is not None:
            text = self.normal.normalize_str(text)
        return [p for p, _ in self.cut.pre_tokenize_str(text)]

    def of(self, stretch: str) -> list[str]:
        """The pre-tokens of a stretch without added tokens."""
        if self.split is None or not _SIMPLE.fullmatch(stretch):
            return self.library(stretch)
        found = self.split(stretch.lower())
        if stretch.isascii():
            return found
        return [p.encode().decode("latin-1").translate(self.shown) for p in found]


@lru_cache(maxsize=2)
def pre_tokens(path: str) -> PreTokens:
    return PreTokens(path)


@lru_cache(maxsize=2)
def model(path: str):
    return Tokenizer.from_file(path).model


def frequencies(texts: list[str], before: PreTokens) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' distinct pre-tokens; rows (text, pre-token, times); and the
    number of added tokens in each text."""
    added = np.zeros(len(texts), np.int64)
    found: list[list[str]] = []
    for i, text in enumerate(texts):
        if before.added is not None and before.added.search(text):
            text, added[i] = before.added.subn(" ", text)
        found.append(_STRETCH.findall(text))
    stretches = {s: i for i, s in enumerate(dict.fromkeys(chain.from_iterable(found)))}
    # the pre-tokens of each distinct stretch, as numbers
    number: dict[str, int] = {}
    cut = [before.of(s) for s in stretches]
    inside = np.fromiter((number.setdefault(p, len(number)) for p in chain.from_iterable(cut)), np.int64)
    many = np.fromiter(map(len, cut), np.int64, len(cut))
    first = np.cumsum(many) - many
    # occurrences of stretches by text, aggregated, then of their pre-tokens
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    text = np.repeat(np.arange(len(found)), sizes)
    which = np.fromiter(map(stretches.__getitem__, chain.from_iterable(found)), np.int64, int(sizes.sum()))
    code, times = np.unique(text * max(1, len(stretches)) + which, return_counts=True)
    text, which = np.divmod(code, max(1, len(stretches)))
    n = many[which]
    at = np.repeat(first[which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return list(number), np.repeat(text, n), inside[at], np.repeat(times, n), added


def count_texts(texts: list[str], path: str) -> np.ndarray:
    """The number of tokens of each text."""
    words, text, word, times, added = frequencies(texts, pre_tokens(path))
    tokenize = model(path).tokenize
    n_pieces = np.fromiter((len(tokenize(w)) for w in words), np.int64, len(words))
    np.add.at(added, text, times * n_pieces[word])
    return added


def parts(text: str, limit: int = PIECE_BYTES) -> Iterator[str]:
    """``text`` cut before white space into parts of about ``limit`` characters."""
    begin = 0
    while begin < len(text):
        gap = _GAP.search(text, begin + limit)
        end = gap.start() if gap else len(text)
        yield text[begin:end]
        begin = end


COUNTS_DDL = "doc_id bigint, n_bytes bigint, n_tokens bigint"


def count(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens`` of each row, as the
    ``tokenizers`` file at ``path`` gives them without its special tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            if len(texts) > 1:
                n = count_texts(texts, path)
            else:
                n = np.array([sum(int(count_texts([p], path)[0]) for p in parts(texts[0]))], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(utf8(batch.column("text"))[1])), pa.array(n)],
                names=["doc_id", "n_bytes", "n_tokens"])

    slim = docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string").alias("text"))
    return arrow_map(slim, run, COUNTS_DDL)
