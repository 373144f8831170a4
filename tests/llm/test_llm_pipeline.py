"""Each stage against brute force on the stage's own input, with planted cases."""

import random
import zlib
from collections import Counter

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from stratum.llm import queries

from conftest import SF_SMALL
from test_llm_minhash import brute as near_brute
from test_llm_packing import verify


def test_registered():
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in entry.queries() and set(queries.QUERIES) <= set(entry.queries())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rnd = random.Random(12)
    clean = [r for r in docs.collect() if 200 < len(r.text) < 4000 and "!!" not in r.text and "***" not in r.text
             and " | " not in r.text]
    planted = []
    for i, r in enumerate(clean[:20]):
        words = r.text.split(" ")
        if i % 2:
            words[rnd.randrange(len(words))] = "changed"        # 5 shingles of 5 words differ
        planted.append((10_000 + i, " ".join(words), r.lang, r.source, r.n_chars))
    planted += [(20_000, None, "en", "src1", 0), (20_001, "", "en", "src1", 0), (20_002, "123 456", "en", "src1", 7)]
    docs = docs.union(spark.createDataFrame(planted, docs.schema))
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = corpus_pipeline.materialize(stage(spark, docs, SF_SMALL), f"test_{name}")
        after = docs.collect()
        ids = Counter(r.doc_id for r in after) if name != "packing" else None
        if name != "packing":
            assert docs.columns == columns
            assert {tuple(r) for r in after} <= {tuple(r) for r in before}
        if name == "quality":
            known = [(labels[r.doc_id], r.doc_id in ids) for r in before if r.doc_id in labels]
            assert np.mean([kept == (q == 1) for q, kept in known]) > 0.95
            assert all(r.doc_id in ids for r in clean if labels.get(r.doc_id) == 1)
        elif name == "language":
            for r in before:
                assert (r.doc_id in ids) == any(map(str.isalpha, r.text or ""))
        elif name == "exact_dedup":
            last = {}
            for r in before:
                last[r.text] = max(last.get(r.text, -1), r.doc_id)
            assert ids == Counter(last.values())
        elif name == "near_dedup":
            want = near_brute(before, 5)
            assert ids == Counter({d: n for (d, _, _, kept), n in want.items() if kept})
            assert len(after) < len(before)
        else:
            verify(before, after, 1024)
            assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in after)


def test_run_and_empty(spark, tmp_path):
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
