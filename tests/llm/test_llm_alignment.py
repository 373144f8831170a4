import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from stratum.llm import alignment, queries
from conftest import SF_SMALL
from llm_traps import no_docs, trap_docs  # noqa: F401

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
A, B = alignment.byte_level(A_PATH), alignment.sentence_pieces(B_PATH)
OWN_A = Tokenizer.from_file(A_PATH)
OWN_A.encode_special_tokens = True
OWN_B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def bytes_a():
    """GPT-2's character for each byte, from the public definition."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in own}
    chars |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    with open(A_PATH, encoding="utf-8") as f:
        return {i: bytes(chars.get(c, 63) for c in t) for t, i in json.load(f)["model"]["vocab"].items()}


BYTES_A = bytes_a()


def bytes_b(i):
    name = OWN_B.id_to_piece(i)
    return bytes([int(name[3:5], 16)]) if OWN_B.is_byte(i) else name.replace("▁", " ").encode()


def brute_align(text):
    """Groups by walking both lists a byte at a time."""
    if not text:
        return [], [], []
    a = OWN_A.encode(" " + text, add_special_tokens=False).ids
    b = OWN_B.encode(text)
    whole = (" " + text).encode()
    if b"".join(BYTES_A[i] for i in a) != whole or b"".join(map(bytes_b, b)) != whole:
        return [], [], []
    groups, i, j, left, right = [], 0, 0, [], []
    at_a = at_b = 0
    for end in range(1, len(whole) + 1):
        ends_a = ends_b = False
        if at_a + len(BYTES_A[a[i]]) == end:
            left, at_a, ends_a, i = left + [a[i]], end, True, min(i + 1, len(a) - 1)
        if at_b + len(bytes_b(b[j])) == end:
            right, at_b, ends_b, j = right + [b[j]], end, True, min(j + 1, len(b) - 1)
        if ends_a and ends_b:
            groups.append((left, right))
            left, right = [], []
    return a, b, groups


def brute(texts):
    aligned = [brute_align(t) for t in texts]
    counts = Counter((g[0][-1], g[1][-1]) for _, _, groups in aligned for g in groups)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for a, b, groups in aligned:
        links = [(g[0][-1], g[1][-1]) for g in groups]
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
    return out


def row(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_groups_equal_a_walk_over_the_bytes(text):
    ids_a, ids_b, cut_a, cut_b = (x.tolist() for x in alignment.align_text(text, A, B))
    a, b, groups = brute_align(text)
    assert (ids_a, ids_b) == (a, b)
    assert [(ids_a[i:x], ids_b[j:y]) for i, x, j, y in
            zip([0, *cut_a], cut_a, [0, *cut_b], cut_b)] == groups


def test_scripts_special_strings_and_texts_that_do_not_come_back():
    rnd = random.Random(11)
    parts = [" ", "  ", "\n", "\t", "\x00", "the", " The", "é", "中文", "😀", "...", "12", "<|endoftext|>", "<s>",
             "</s>", "<unk>", "<0x41>", "ﬁ", "​"]
    for _ in range(600):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 20)))
        ids_a, ids_b, cut_a, _ = alignment.align_text(text, A, B)
        a, b, groups = brute_align(text)
        assert (ids_a.tolist(), ids_b.tolist(), len(cut_a)) == (a, b, len(groups)), repr(text)
    for text in ("▁", "a ▁ b"):
        assert all(len(x) == 0 for x in alignment.align_text(text, A, B))


def test_texts_are_cut_without_a_trace():
    rnd = random.Random(12)
    parts = ["a", "b ", " ", "  ", "the ", "x\n", "\n", "▁", "é", "中", " end", ". "]
    assert B.cuttable
    for _ in range(2000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 120)))
        assert B.encode(text).tolist() == OWN_B.encode(text), repr(text)
        if text:
            cut = alignment.segments(text)
            assert " ".join(cut) == text
            got = [A.encode(" " + x).tolist() for x in cut]
            assert sum(got, []) == OWN_A.encode(" " + text, add_special_tokens=False).ids, repr(text)


def test_texts_of_a_batch_are_encoded_as_one_by_one():
    texts = ["the cat  the cat", "", " the ", "a \n the", "▁ the", "the cat"]
    assert [x.tolist() for x in B.encode_all(texts)] == [OWN_B.encode(t) for t in texts]


def test_ends_are_the_same_in_stretches():
    rnd = random.Random(13)
    for _ in range(200):
        ends = [np.cumsum([rnd.randint(1, 4) for _ in range(rnd.randint(1, 60))]) for _ in range(2)]
        whole = alignment.common_ends(*ends)
        parts = alignment.common_ends(*ends, stretch=rnd.randint(1, 9))
        assert all(x.tolist() == y.tolist() for x, y in zip(whole, parts))
        assert set(ends[0][whole[0]].tolist()) == set(ends[0].tolist()) & set(ends[1].tolist())


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 300_000, "\n" * 300_000, "ab, " * 100_000])
def test_long_texts(text):
    ids_a, ids_b, cut_a, cut_b = alignment.align_text(text, A, B)
    assert ids_a.tolist() == OWN_A.encode(" " + text, add_special_tokens=False).ids
    assert ids_b.tolist() == OWN_B.encode(text)
    assert (cut_a[-1], cut_b[-1]) == (len(ids_a), len(ids_b))


def test_pairs_stay_within_the_bound(spark, trap_docs):
    assert alignment.most_pairs([b"ab", b"b"], [b"b", b"cb", b""]) == 3
    linked = alignment.links(trap_docs, A_PATH, B_PATH)
    pairs = alignment.pair_counts(linked).collect()
    assert 0 < len(pairs) <= alignment.most_pairs(A.bytes_of, B.bytes_of) < alignment.PAIR_LIMIT
    for r in pairs:
        x, y = BYTES_A[r.a], bytes_b(r.b)
        assert x.endswith(y) or y.endswith(x)


def test_aligned_lists_of_a_frame(trap_docs):
    def unpacked(x):
        return [int.from_bytes(x[i:i + 4], "little") for i in range(0, len(x), 4)]

    def parts(ids, cuts):
        return [ids[i:j] for i, j in zip([0, *cuts], cuts)]
    got = Counter()
    for r in alignment.align(trap_docs, A_PATH, B_PATH).collect():
        ids_a, ids_b, cut_a, cut_b = map(unpacked, (r.a_ids, r.b_ids, r.a_cuts, r.b_cuts))
        got[repr((r.doc_id, ids_a, ids_b, list(zip(parts(ids_a, cut_a), parts(ids_b, cut_b)))))] += 1
    assert got == Counter(repr((d.doc_id, *brute_align(d.text))) for d in trap_docs.collect())


def test_digests_are_the_same_in_parts_and_for_large_ids(monkeypatch):
    rnd = random.Random(16)
    for most in (9, 50_000, 1 << 20):
        cuts = [np.cumsum([rnd.randint(1, 3) for _ in range(40)]).astype(np.uint32) for _ in range(2)]
        ids = [np.array([rnd.randrange(most) for _ in range(c[-1])], np.uint32) for c in cuts]
        shown = ";".join(",".join(map(str, ids[0][i:x].tolist())) + "|" + ",".join(map(str, ids[1][j:y].tolist()))
                         for i, x, j, y in zip([0, *cuts[0]], cuts[0], [0, *cuts[1]], cuts[1]))
        for size in (1, 7, 1 << 16):
            monkeypatch.setattr(alignment, "GROUPS", size)
            assert alignment.groups_digest(*ids, *cuts) == hashlib.sha256(shown.encode()).hexdigest()


def test_every_row_of_a_frame(trap_docs):
    docs = trap_docs.collect()
    got = Counter((r.doc_id, *row(r)) for r in alignment.link_quality(trap_docs, A_PATH, B_PATH).collect())
    assert got == Counter((d.doc_id, *r) for d, r in zip(docs, brute([d.text for d in docs])))


def test_empty_table(no_docs):
    assert alignment.link_quality(no_docs, A_PATH, B_PATH).collect() == []


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: row(r) for r in queries.op11_alignment(spark, SF_SMALL).collect()}
    assert got == dict(zip([d.doc_id for d in docs], brute([d.text for d in docs])))


def test_of_tokens_that_end_together_in_one_list_the_last_counts():
    ends_a, ends_b = np.array([2, 2, 3, 7, 9]), np.array([1, 2, 7, 7, 9, 9])
    for stretch in (1, 4, 100):
        at_a, at_b = alignment.common_ends(ends_a, ends_b, stretch=stretch)
        assert (at_a.tolist(), at_b.tolist()) == ([1, 3, 4], [1, 3, 5])
