import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st

from stratum.llm import queries, resampling
from stratum.llm.common import utf8
from conftest import SF_SMALL
from llm_traps import no_docs, trap_docs  # noqa: F401

import pyarrow as pa

CONFIG = resampling.ResamplingConfig()
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def features(text):
    w = words(text)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, targets, percent=5, min_words=20):
    """(doc_id, n_features, weight, score, rank) of each (doc_id, text)."""
    def count(texts):
        return Counter(zlib.crc32(f.encode()) % 10000 for t in texts for f in features(t))
    corpus, target = count(t for _, t in docs), count(targets)
    s_all, t_all = sum(corpus.values()), sum(target.values())
    gain = [math.floor(1000 * math.log((target[b] + 1) * (s_all + 10000) / ((corpus[b] + 1) * (t_all + 10000))))
            for b in range(10000)]
    rows = []
    for doc_id, text in docs:
        found = features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % 10000] for f in found)
        h = int(hashlib.sha256(f"42:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, score, len(words(text)) >= min_words))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = len(able) * percent // 100
    ranks = {id(r): k + 1 for k, r in enumerate(able[:drawn])}
    return Counter((*r[:4], ranks.get(id(r))) for r in rows)


def as_rows(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_words_and_runs_of_many_texts(texts):
    raw, at = utf8(pa.array(texts, pa.string()))
    if len(at) < 2:
        return
    found = resampling.Words(raw, at)
    spelled = [bytes(found.buffer[a:b]).decode() for a, b in zip(found.start, found.end)]
    assert [(t, w) for t, w in zip(found.text.tolist(), spelled)] == \
        [(i, w) for i, t in enumerate(texts) for w in words(t)]
    if len(found):
        start, end, text = found.runs(0, len(found), 3)
        got = Counter((t, bytes(found.buffer[a:b]).decode()) for a, b, t in zip(start, end, text.tolist()))
        assert got == Counter((i, f) for i, t in enumerate(texts) for f in features(t))


def test_table_tells_runs_with_equal_keys_apart():
    parts = [b"alpha", b"beta", b"alpha", b"gamma and more bytes", b"gamma and more bytez", b"beta", b"a", b"b",
             b"gamma and more bytes"]
    buffer = np.frombuffer(b"".join(parts), np.uint8)
    end = np.cumsum([len(p) for p in parts])
    start = end - [len(p) for p in parts]
    for key in (np.zeros(len(parts), np.uint64), np.full(len(parts), (1 << 64) - 1, np.uint64), None):
        table = resampling.Table(buffer, 10000, len(parts))
        slot = table.intern(start, end, key)
        for i, p in enumerate(parts):
            for j, q in enumerate(parts):
                assert (slot[i] == slot[j]) == (p == q)
            assert table.count[slot[i]] == parts.count(p)
            assert table.bucket[slot[i]] == zlib.crc32(p) % 10000
        again = table.intern(start, end, key)
        assert again.tolist() == slot.tolist()


def test_hashes_are_those_of_the_libraries():
    import random

    import xxhash
    rnd = random.Random(5)
    buffer = np.frombuffer(bytes(rnd.randrange(256) for _ in range(5000)), np.uint8)
    table = resampling.Table(buffer, 10000, 10)
    size = np.array([rnd.randint(1, 31) for _ in range(3000)] + list(range(1, 32)))
    start = np.array([rnd.randint(0, 5000 - n) for n in size])
    runs = [buffer[a:a + n].tobytes() for a, n in zip(start, size)]
    assert resampling.xxhash64(table.eight, start, size).tolist() == [xxhash.xxh64_intdigest(r) for r in runs]
    size = np.array([rnd.randint(1, 127) for _ in range(3000)] + [5, 4, 3, 2, 1])
    start = np.array([rnd.randint(0, 5000 - n) for n in size])
    assert resampling.crc32(table.eight, start, size).tolist() == \
        [zlib.crc32(buffer[a:a + n].tobytes()) for a, n in zip(start, size)]
    ends = np.array([5000, 5000, 40, 33, 32, 31])
    starts = np.array([0, 4990, 0, 0, 0, 0])
    key = table._each(starts, ends, resampling.SHORT_HASH, resampling.xxhash64, xxhash.xxh64_intdigest)
    assert key.tolist() == [xxhash.xxh64_intdigest(buffer[a:b].tobytes()) for a, b in zip(starts, ends)]


def test_small_tables_give_the_same_counts(spark, trap_docs, monkeypatch):
    whole = resampling.bucket_counts(trap_docs, CONFIG)
    monkeypatch.setattr(resampling, "WORDS", 7)
    small = trap_docs.where("length(text) < 1000")
    want = Counter(zlib.crc32(f.encode()) % 10000 for r in small.collect() for f in features(r.text))
    got = resampling.bucket_counts(small, CONFIG)
    assert {i: int(n) for i, n in enumerate(got) if n} == dict(want)
    assert whole.sum() == sum(len(features(r.text)) for r in trap_docs.collect())


def test_every_row_of_a_frame(spark, trap_docs):
    target = spark.createDataFrame([("The cat and the dog",), (None,), ("",)], "text string")
    config = resampling.ResamplingConfig(percent=50, min_words=8)
    docs = [(r.doc_id, r.text) for r in trap_docs.collect()]
    want = brute(docs, ["The cat and the dog", None, ""], 50, 8)
    assert as_rows(resampling.resample(trap_docs, target, config)) == want


def test_long_texts(spark):
    texts = ["a" * 1_000_000, " " * 1_000_000, "\n" * 1_000_000, "ab " * 300_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    target = docs.where("doc_id = 3")
    assert as_rows(resampling.resample(docs, target)) == brute(list(enumerate(texts)), [texts[3]])


def test_empty_tables(spark, no_docs, trap_docs):
    assert resampling.resample(no_docs, trap_docs).collect() == []
    docs = [(r.doc_id, r.text) for r in trap_docs.collect()]
    assert as_rows(resampling.resample(trap_docs, no_docs)) == brute(docs, [])


def test_ties_and_repeated_rows_are_all_ranked(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = [(7, text)] * 60 + [(None, text)] * 20 + [(i, text) for i in range(100, 120)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    config = resampling.ResamplingConfig(percent=95)
    out = resampling.resample(frame, frame, config).collect()
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, 96))
    assert as_rows(resampling.resample(frame, frame, config)) == brute(docs, [t for _, t in docs], 95)


def test_query_against_brute_force(spark):
    read = [spark.read.parquet(f"{SF_SMALL}/{t}.parquet").collect() for t in ("documents", "benchmark")]
    want = brute([(r.doc_id, r.text) for r in read[0]], [r.text for r in read[1]])
    assert as_rows(queries.op12_resampling(spark, SF_SMALL)) == want
