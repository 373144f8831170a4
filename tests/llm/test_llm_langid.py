import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from stratum.llm import langid
from stratum.llm.common import code_points

from conftest import SF_CHECK, SF_SMALL
from llm_traps import no_docs, trap_docs  # noqa: F401


def spans(text):
    out, prev = [], False
    for c in text or "":
        if c.isalpha():
            low = c.lower()
            out.append(low if len(low) == 1 else c)
        elif prev:
            out.append(" ")
        prev = c.isalpha()
    return "".join(out)


def test_normalise():
    texts = ["Ab  c!", None, "", "é1é", "xyz", "  İ𝔸b", "9"]
    chars, at, has = langid.normalise(*code_points(pa.array(texts)))
    got = ["".join(map(chr, chars[a:b])) for a, b in zip(at, at[1:])]
    assert got == [spans(t) for t in texts]
    assert has.tolist() == [True, False, False, True, True, True, False]


def bucket(gram, config):
    h = len(gram)
    for c in gram:
        h = h * 0x9E3779B1 & 0xFFFFFFFF
        h ^= h >> 15
        h = (h + ord(c)) & 0xFFFFFFFF
    h = h * 0x9E3779B1 & 0xFFFFFFFF
    h ^= h >> 13
    return (h * 0x85EBCA6B & 0xFFFFFFFF) >> (32 - config.bits)


def test_scores_match_brute_force_bayes(spark, trap_docs):
    config = langid.LangConfig(bits=8)
    rows = [r for r in trap_docs.collect()]
    counts, docs = {}, Counter()
    for r in rows:
        if r.text is None or r.lang is None:
            continue
        docs[r.lang] += 1
        text = spans(r.text)
        for n in config.orders:
            for i in range(len(text) - n + 1):
                counts.setdefault(r.lang, Counter())[bucket(text[i:i + n], config)] += 1
    model = langid.fit(trap_docs, config)
    assert model.languages == ("de", "en", "es")
    total = {k: sum(v.values()) + config.alpha * 256 for k, v in counts.items()}
    want = {}
    for r in rows:
        text = spans(r.text)
        logs = [math.log(docs[k] / sum(docs.values())) + sum(
            math.log((counts[k][bucket(text[i:i + n], config)] + config.alpha) / total[k])
            for n in config.orders for i in range(len(text) - n + 1)) for k in model.languages]
        p = np.exp(np.array(logs) - max(logs))
        best = int(np.argmax(p))
        want[r.text] = (model.languages[best], p[best] / p.sum()) if any(map(str.isalpha, r.text or "")) \
            else ("und", 0.0)
    out = langid.predict(trap_docs, model)
    assert out.columns == [c for c in trap_docs.columns if c != "score"] + ["lang_pred", "score"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.lang_pred == want[r.text][0]
        assert abs(r.score - want[r.text][1]) < 1e-3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = langid.identify(docs).select("doc_id", "held_out", "lang", "lang_pred", "score").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert held and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_without_training_rows_and_empty(spark, trap_docs, no_docs):
    model = langid.fit(no_docs)
    assert {(r.lang_pred, r.score) for r in langid.predict(trap_docs, model).collect()} == {("und", 0.0)}
    assert langid.identify(no_docs).collect() == []


def test_stage_drops_only_what_has_no_language(trap_docs):
    out = langid.keep_identified(trap_docs)
    assert out.columns == trap_docs.columns
    kept = Counter(r.doc_id for r in out.collect())
    assert kept == Counter({1: 1, 2: 1, 5: 1, 6: 1, 8: 1, 9: 2, None: 1, 10: 1})
    assert {r.score for r in out.collect()} == {1}      # the input's own column


GREEK = "\u03b7 \u03b3\u03bb\u03ce\u03c3\u03c3\u03b1 \u03b5\u03af\u03bd\u03b1\u03b9 \u03ad\u03bd\u03b1 \u03c3\u03cd\u03c3\u03c4\u03b7\u03bc\u03b1 "
JAPANESE = "\u65e5\u672c\u8a9e\u306e\u6587\u7ae0\u306f\u7a7a\u767d\u304c\u306a\u3044 "


def test_texts_of_no_learned_language_go_and_clean_ones_stay(spark):
    import random
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rnd = random.Random(9)
    planted = [(900_000 + i, GREEK * 4, "en", "s", 1) for i in range(3)]
    planted += [(900_010 + i, JAPANESE * 4, None, "s", 1) for i in range(3)]
    planted += [(900_020 + i, " ".join("".join(rnd.choice("bcdfghjklmnpqrstvwxz") for _ in range(rnd.randint(3, 9)))
                                       for _ in range(60)), "fr", "s", 1) for i in range(3)]
    both = docs.union(spark.createDataFrame(planted, docs.schema)).withColumn("Score", docs["doc_id"] * 0 + 7)
    out = langid.keep_identified(both)
    assert out.columns == both.columns and {r.Score for r in out.collect()} == {7}
    kept = {r.doc_id for r in out.collect()}
    assert not kept & {p[0] for p in planted}
    clean = {r.doc_id for r in docs.collect() if any(map(str.isalpha, r.text or ""))}
    assert kept == clean


def test_variance_is_split_by_length():
    rng = np.random.default_rng(4)
    n = rng.integers(1, 500, 20_000)
    y = -7 + rng.normal(size=len(n)) * np.sqrt(0.04 + 3.0 / n)
    x = 1 / n
    m, a, b = langid._variance(len(n), x.sum(), (x * x).sum(), y.sum(), (y * x).sum(), (y * y).sum(), (y * y * x).sum())
    assert abs(m + 7) < 0.02 and abs(a - 0.04) < 0.01 and abs(b - 3) < 0.3


def test_bounds_are_the_moments_of_the_training_rows(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    model = langid.fit(docs)
    bounded = langid.with_bounds(model, docs.repartition(4), trim=None)
    for i, name in enumerate(model.languages):
        own = [r.text for r in docs.collect() if r.lang == name and any(map(str.isalpha, r.text or ""))]
        chars, at, _ = langid.normalise(*code_points(pa.array(own)))
        total, n = langid.log_likelihood(model, chars, at)
        assert abs(bounded.mean[i] - np.mean(total[:, i] / n)) < 1e-6
