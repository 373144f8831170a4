import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from stratum.llm import minhash
from stratum.llm.common import utf8
from stratum.llm.components import components
from stratum.llm.minhash import MinHashConfig, near_groups, one_of_each

from conftest import SF_SMALL
from llm_traps import no_docs, trap_docs  # noqa: F401

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
LAST = 1 << 63


def shingle_set(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) < words:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + words]) for i in range(len(w) - words + 1))


def brute(rows, words):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    own = [(r.doc_id, shingle_set(r.text, words)) for r in rows]
    up = list(range(len(own)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, (_, a) in enumerate(own):
        for j in range(i):
            b = own[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                up[find(i)] = find(j)
    key = [LAST if d is None else d for d, _ in own]
    least = {}
    for i in range(len(own)):
        least[find(i)] = min(least.get(find(i), LAST), key[i])
    out = []
    for i, (doc_id, s) in enumerate(own):
        first = least[find(i)]
        out.append((doc_id, len(s), None if first == LAST else first, key[i] == first))
    return Counter(out)


def check(docs, config):
    assert Counter(map(tuple, near_groups(docs, config).collect())) == brute(docs.collect(), config.words)


def test_word_hashes_follow_words():
    texts = ["A b\tA", None, "", " x\x0bX x\r\n", "É é", "a\x1cb a\x1cb", "ab", "b a"]
    hashes, at = minhash.word_hashes(*utf8(pa.array(texts)))
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in words]
    flat = [w for own in words for w in own]
    for i, a in enumerate(flat):
        for j, b in enumerate(flat):
            assert (hashes[i] == hashes[j]) == (a == b)


def test_signature_is_circulant():
    members = np.array([3, 99, 1 << 40], np.uint64)
    spread = minhash._permute((members ^ (members >> np.uint64(32))).astype(np.uint32) * np.uint32(0x9E3779B1))
    want = [min(int(minhash._permute(np.array([(int(x) + k) % (1 << 32)], np.uint32))[0]) for x in spread)
            for k in range(8)]
    assert minhash.signature(members, 8).tolist() == want


def test_signature_estimates_jaccard():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(40):
        common, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (400, 50, 50))
        x = minhash.signature(np.concatenate((common, a)), 160)
        y = minhash.signature(np.concatenate((common, b)), 160)
        errors.append((x == y).mean() - 0.8)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_driver_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check(docs, MinHashConfig(words=2))
    check(docs, MinHashConfig())


def test_traps(trap_docs, no_docs):
    check(trap_docs, MinHashConfig(words=2))
    check(trap_docs, MinHashConfig())
    assert near_groups(no_docs).collect() == []
    assert one_of_each(no_docs).collect() == []


def test_group_of_near_copies_whose_links_are_on_the_edge(spark):
    """Edited copies of one text, many pairs just above and below the threshold;
    blocks smaller than the group."""
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(w if rnd.random() > rnd.choice((0.02, 0.05, 0.09)) else f"e{i}x{k}"
                         for k, w in enumerate(base))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(docs, MinHashConfig(words=1, block=16))
    check(docs, MinHashConfig(words=2, block=16))


def test_chain_of_links_is_one_component(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(100 - i, " ".join(words[10 * i:10 * i + 200])) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_groups(docs, MinHashConfig(words=2)).collect()
    assert {r.component_id for r in got} == {81}
    check(docs, MinHashConfig(words=2))


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 40), (60, 60)], "a long, b long")
    got = {r.node: r.comp for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(31)}, 40: 40, 50: 40}


def test_one_of_each_keeps_columns(trap_docs):
    out = one_of_each(trap_docs)
    assert out.columns == trap_docs.columns
    # 1, 2 and the null id share a text; 9 is 5 with one more word
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4, 5, 6, 7, 8, 10]


def test_one_of_each_decides_by_row(spark):
    """Null and shared doc_ids: one row of each group stays, and all that have no copy."""
    base = [f"w{i}" for i in range(60)]

    def text(tag, k=None):
        return " ".join(f"{tag}{w}" if i != k else "changed" for i, w in enumerate(base))
    rows = [(1, text("a")), (None, text("a")), (None, text("a", 0)),    # a copy and a near copy without id
            (None, text("b")),                                           # unique, without id
            (2, text("c")), (3, text("c")), (3, text("d")),              # one doc_id, two texts: d is unique
            (4, text("e")), (4, text("e", 59)),                          # near copies that share a doc_id
            (None, text("f")), (None, text("f", 59)), (None, text("f")),  # all without id
            (5, text("g")), (5, text("g")), (None, None), (None, ""), (None, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(map(tuple, one_of_each(docs).collect()))
    assert got.total() == 10 and set(got) <= set(rows)
    own = Counter((d, (t or " ")[0]) for (d, t), n in got.items() for _ in range(n))
    assert own == Counter({(1, "a"): 1, (None, "b"): 1, (2, "c"): 1, (3, "d"): 1, (4, "e"): 1, (None, "f"): 1,
                           (5, "g"): 1, (None, " "): 3})
