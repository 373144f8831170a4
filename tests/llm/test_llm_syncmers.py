import hashlib
import random

import numpy as np

from stratum.llm import syncmers
from stratum.llm.syncmers import Fingerprint, SyncmerConfig, anchors, compare, likeness

from conftest import SF_SMALL
from llm_traps import no_docs, trap_docs  # noqa: F401

CONFIG = SyncmerConfig()


def points(text):
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def mix(x):
    return int(syncmers._mix(np.array([x], np.uint64))[0])


def brute_places(text, config):
    def h(part):
        out = 0
        for c in part:
            out = (out * syncmers._BASE + mix(ord(c) + 1)) % (1 << 64)
        return mix(out)
    found = []
    for i in range(len(text) - config.k + 1):
        small = [h(text[i + j:i + j + config.s]) for j in range(config.k - config.s + 1)]
        if min(small) in (small[0], small[-1]):
            found.append(i)
    return found


def test_anchors_are_the_closed_syncmers():
    rnd = random.Random(8)
    for config in (CONFIG, SyncmerConfig(k=5, s=2), SyncmerConfig(k=7, s=7), SyncmerConfig(k=9, s=4)):
        text = "".join(rnd.choice("abcé😀 ") for _ in range(150))
        assert anchors(points(text), config)[1].tolist() == brute_places(text, config)


def test_anchors_are_context_free():
    rnd = random.Random(9)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(300))
    alone = set(anchors(points(passage), CONFIG)[0].tolist())
    inside = set(anchors(points("some words before " + passage + " and after"), CONFIG)[0].tolist())
    assert alone <= inside


def test_fingerprint_round_trip_and_likeness():
    a = Fingerprint.of(points("the quick brown fox jumps over the lazy dog " * 9), CONFIG)
    b = Fingerprint.parse(a.text())
    assert a.text() == b.text() and likeness(a, b, CONFIG.size) == 1.0
    empty = Fingerprint.of(points(""), CONFIG)
    assert empty.text() == "" and likeness(empty, empty, 64) == 1.0 and likeness(empty, a, 64) == 0.0
    short = Fingerprint.of(points("abc"), CONFIG)
    assert len(short.hashes) == 1 and likeness(short, Fingerprint.of(points("abd"), CONFIG), 64) == 0.0


def brute(rows):
    rows = sorted(((r.doc_id, r.text or "") for r in rows),
                  key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), r[1].encode()))
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, new = (Fingerprint.of(points(t), CONFIG) for t in (text, edited))
        yield (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.text(), new.text(),
               1.0 if edited == text else likeness(own, new, 64),
               1.0 if following == text else likeness(own, Fingerprint.of(points(following), CONFIG), 64))


def test_neighbours_match_brute_force(spark, trap_docs):
    for docs in (trap_docs, spark.read.parquet(f"{SF_SMALL}/documents.parquet")):
        want = sorted(brute(docs.collect()), key=str)
        for parts in (1, 4, 40):
            assert sorted(map(tuple, compare(docs, CONFIG, parts).collect()), key=str) == want


def test_one_and_no_document(spark, no_docs):
    one = spark.createDataFrame([(5, "abcdefgh" * 9)], "doc_id long, text string")
    (row,) = compare(one, CONFIG, 3).collect()
    assert row.near_next == 1.0 and row.n_chars == 72
    assert compare(no_docs, CONFIG, 3).collect() == []


def test_edits_are_nearer_than_other_documents(spark):
    rows = compare(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), CONFIG, 4).where("n_chars > 500").collect()
    assert sum(r.near_edited > r.near_next for r in rows) / len(rows) > 0.97


def test_fingerprint_holds_every_anchor_of_a_shared_passage():
    rnd = random.Random(10)

    def some(n):
        return "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = some(350)
    alone = set(Fingerprint.of(points(passage), CONFIG).hashes.tolist())
    a, b = (Fingerprint.of(points(some(10_000) + passage + some(10_000)), CONFIG) for _ in range(2))
    assert len(alone) > 50 and alone <= set(a.hashes.tolist()) & set(b.hashes.tolist())
    union = len(set(a.hashes.tolist()) | set(b.hashes.tolist()))
    assert len(alone) / union <= likeness(a, b) < 2 * len(alone) / union
    moved = Fingerprint.of(points("x" + passage[200:] + passage[:200]), CONFIG)
    assert 0.4 < likeness(Fingerprint.of(points(passage), CONFIG), moved) < 0.7     # matches in order only
