import random
from collections import Counter

import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from stratum.llm import queries, token_counts
from conftest import SF_SMALL
from llm_traps import no_docs, trap_docs  # noqa: F401

PATH = public_tokenizers.path("word_bpe_49k.json")
REFERENCE = Tokenizer.from_file(PATH)
REFERENCE.no_truncation()
REFERENCE.no_padding()


def brute(text):
    return len(REFERENCE.encode(text or "", add_special_tokens=False).ids)


def by_pre_tokens(text):
    return int(token_counts.count_texts([text], PATH)[0])


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_equals_the_library(text):
    assert by_pre_tokens(text) == brute(text)


def test_white_space_scripts_case_and_added_tokens():
    rnd = random.Random(13)
    parts = [" ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", " ", "​", "　", "᠎", "the", "The",
             "'s", "'LL", "23", "É", "é", "́", "中文", "!", "...", "😀", "İ", "ΑΣ", "Σ", "ß", "ſ", "K",
             "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "ﬁ", "½", "\x00", "한", "하"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert by_pre_tokens(text) == brute(text), repr(text)


def test_every_row_of_a_frame(trap_docs):
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.count(trap_docs, PATH).collect())
    want = Counter((r.doc_id, len((r.text or "").encode()), brute(r.text)) for r in trap_docs.collect())
    assert got == want


def test_long_texts_without_blanks_or_of_blanks_alone(spark):
    texts = ["a" * 1_000_000, " " * 1_000_000, "\n" * 1_000_000, "é,1" * 200_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count(docs, PATH).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_parts_of_a_long_text():
    rnd = random.Random(14)
    for _ in range(300):
        text = "".join(rnd.choice(["ab", " ", "\n", "é", "<|endoftext|>", "  ", "\t", "c-d"]) for _ in range(60))
        cut = list(token_counts.parts(text, rnd.randint(1, 30)))
        assert "".join(cut) == text
        assert sum(map(by_pre_tokens, cut)) == brute(text)


def test_frequencies_join_on_distinct_pre_tokens():
    texts = ["the cat, the THE cat", "", "cat<|endoftext|>cat é É", "x"]
    words, text, word, times, added = token_counts.frequencies(texts, token_counts.pre_tokens(PATH))
    assert len(words) == len(set(words))
    got = [Counter() for _ in texts]
    for i, w, n in zip(text, word, times):
        got[i][words[w]] += n
    assert got[0] == {"the": 3, "cat": 2, ",": 1} and got[1] == {} and got[2] == {"cat": 2, "Ã©": 2}
    assert added.tolist() == [0, 0, 1, 0]


def test_simple_stretches_are_cut_as_the_library_does():
    rnd = random.Random(15)
    before = token_counts.pre_tokens(PATH)
    signs = [chr(c) for c in (*range(33, 127), *range(0xC0, 0x100))]
    for _ in range(5000):
        stretch = "".join(rnd.choice(signs) for _ in range(rnd.randint(1, 12)))
        assert before.of(stretch) == before.library(stretch), stretch
    for stretch in ("it's", "IT'S", "we'll", "'re", "d'd", "a1b22", "ÀÉÞß×÷ÿ"):
        assert before.of(stretch) == before.library(stretch)


def test_empty_table(no_docs):
    assert token_counts.count(no_docs, PATH).collect() == []


def test_query_against_the_library(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit)
           for r in queries.op13_token_counts(spark, SF_SMALL).collect()}
    assert got == {r.doc_id: (len((r.text or "").encode()), brute(r.text), brute(r.text) > 2048) for r in docs}
