import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from stratum.llm import packing

from conftest import SF_SMALL
from llm_traps import no_docs, trap_docs  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_50k.json")
REFERENCE = Tokenizer.from_file(PATH)
REFERENCE.encode_special_tokens = True


def tokens(text):
    return REFERENCE.encode(text or "", add_special_tokens=False).ids + [0]


def verify(docs, pieces, window):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id, r.doc_tokens].append(r)
        by_sequence[r.sequence_id].append(r)
    want = defaultdict(list)
    for r in docs:
        ids = tokens(r.text)
        for start in range(0, len(ids), window):
            part = ids[start:start + window]
            want[r.doc_id, len(ids)].append((start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert {k: sorted((r.start, r.length, r.ids_crc32) for r in v) for k, v in by_doc.items()} == \
        {k: sorted(v) for k, v in want.items()}
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return by_sequence


def test_whole_table_packs_tightly(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    sequences = verify(docs.collect(), packing.pack(docs, PATH).collect(), 1024)
    total = sum(r.length for own in sequences.values() for r in own)
    assert len(sequences) <= -(-total // 1024) * 1.06 + 1
    assert sorted(sequences) == list(range(len(sequences)))


def test_traps(trap_docs, no_docs):
    verify(trap_docs.collect(), packing.pack(trap_docs, PATH, window=64).collect(), 64)
    assert packing.pack(no_docs, PATH).collect() == []


def test_ids_are_those_of_tokenizers():
    rnd = random.Random(5)
    own = packing.encoder(PATH)
    parts = [" ", "  ", "\n", "\t", "\x1c", "\x85", " ", "　", "th", "The", "'s", "23", "é", "中文", "!",
             "...", "😀", "́", "ا", "½", "<|endoftext|>", "\x00"]
    for _ in range(2000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert own.encode_to_numpy(text).tolist() + [0] == tokens(text)


def test_added_tokens_are_those_of_tokenizers_by_default(spark):
    default = Tokenizer.from_file(PATH)
    encode = packing.tokenizer(PATH)
    assert encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    rnd = random.Random(8)
    parts = [" ", "  ", "\n", "th", "'s", "é", "中文", "<|", "|>", "<|endoftext|>", "<|endoftext|>", "endoftext"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(2000)]
    want = [default.encode(t, add_special_tokens=False).ids for t in texts]
    assert [encode(t).tolist() for t in texts] == want
    docs = spark.createDataFrame(list(enumerate(texts[:200])), "doc_id long, text string")
    got = {r.doc_id: (r.ids_crc32, r.doc_tokens) for r in packing.pack(docs, PATH).collect()}
    assert got == {i: (zlib.crc32(np.array(ids + [0], "<u4").tobytes()), len(ids) + 1)
                   for i, ids in enumerate(want[:200])}


def best_sum(counts, capacity):
    reach = {0}
    for length, n in counts.items():
        for _ in range(n):
            reach |= {s + length for s in reach if s + length <= capacity}
    return max(reach)


def test_fill_is_optimal():
    rnd = random.Random(6)
    for _ in range(200):
        counts = {rnd.randint(1, 40): rnd.randint(1, 4) for _ in range(rnd.randint(0, 6))}
        capacity = rnd.randint(0, 100)
        chosen = packing.fill(counts, capacity)
        assert all(0 < n <= counts[k] for k, n in chosen.items())
        assert sum(k * n for k, n in chosen.items()) == best_sum(counts, capacity)


def test_plan_uses_every_length_once_and_stays_small():
    rnd = random.Random(7)
    histogram = {n: 50_000 + rnd.randint(0, 9) for n in range(1, 1024)}
    slots = packing.plan(histogram, 1024)
    assert len(slots.key) < 8192                    # whatever the counts are
    assert slots.windows <= 1.001 * sum(k * n for k, n in histogram.items()) / 1024 + 1
    assert packing.plan({}, 1024).windows == 0
    assert packing.plan({600: 5}, 1024).windows == 5


def test_long_runs_are_whole(spark):
    texts = [" " * 1_000_000, "\n" * 1_000_000, "a" * 1_000_000, "x" + "\t " * 400_000 + "<|endoftext|> y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    default = Tokenizer.from_file(PATH)
    got = defaultdict(dict)
    for r in packing.pack(docs, PATH).collect():
        got[r.doc_id][r.start] = np.frombuffer(r.ids, "<u4")
    for i, t in enumerate(texts):
        ids = np.concatenate([got[i][s] for s in sorted(got[i])])
        assert ids.tolist() == default.encode(t, add_special_tokens=False).ids + [0]


def test_sequences_hold_the_ids_of_their_pieces(trap_docs, no_docs):
    window = 64
    placed = packing.pack(trap_docs, PATH, window=window)
    rows = placed.collect()
    out = {r.sequence_id: r for r in packing.sequences(placed, window, pad_id=7).collect()}
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
    assert set(out) == set(by_sequence)
    for k, own in by_sequence.items():
        own.sort(key=lambda r: r.offset)
        ids = b"".join(bytes(r.ids) for r in own)
        assert bytes(out[k].ids) == ids + (7).to_bytes(4, "little") * (window - len(ids) // 4)
        assert out[k].length == len(ids) // 4
        assert (out[k].doc_ids, out[k].starts, out[k].lengths) == tuple(
            [r[c] for r in own] for c in ("doc_id", "start", "length"))
    assert packing.sequences(packing.pack(no_docs, PATH)).collect() == []
