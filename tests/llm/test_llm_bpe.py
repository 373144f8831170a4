import random

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings, strategies as st

from stratum.llm import bpe
from stratum.llm.common import chunks
from llm_traps import no_docs, trap_docs  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BPE = bpe.load(PATH, public_tokenizers.PATTERN)
TIKTOKEN = tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=BPE.ranks, special_tokens={})


def ids(text):
    return np.frombuffer(BPE.encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_equals_tiktoken_and_round_trips(text):
    assert ids(text) == TIKTOKEN.encode_ordinary(text)
    assert BPE.decode(BPE.encode(text)) == text.encode()


def test_white_space_contractions_and_scripts():
    rnd = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "\r", "\x1c", "\x85", " ", "​", "　", "᠎", "th", "The",
             "'s", "'ll", "23", "é", "中文", "!", "...", "😀", "́", "ا", "½", "<|endoftext|>"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert ids(text) == TIKTOKEN.encode_ordinary(text), repr(text)


def test_backtracking_equals_the_merges():
    rnd = random.Random(4)
    for _ in range(2000):
        piece = bytes(rnd.choice(b"abcdeinst \xc3\xa9") for _ in range(rnd.randint(1, 40)))
        if piece not in BPE.ranks:
            assert BPE.encode_piece(piece) == BPE.merge(piece)


def test_chunks_join_to_the_text():
    for text in ("", " ", "a b", " a  b ", "a \n b", "x  y", "   "):
        assert "".join(chunks(text)) == text


def test_frames(trap_docs, no_docs):
    out = bpe.round_trip(trap_docs, PATH, public_tokenizers.PATTERN)
    rows = {(r.doc_id, bytes(r.decoded)): bytes(r.ids) for r in out.collect()}
    for r in trap_docs.collect():
        packed = rows[(r.doc_id, (r.text or "").encode())]
        assert np.frombuffer(packed, "<u4").tolist() == TIKTOKEN.encode_ordinary(r.text or "")
    assert out.count() == trap_docs.count()
    assert bpe.round_trip(no_docs, PATH, public_tokenizers.PATTERN).collect() == []
