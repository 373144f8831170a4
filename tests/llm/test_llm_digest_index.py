import hashlib

from stratum.llm.digest_index import DigestIndex, exact_dedup
from llm_traps import no_docs, trap_docs  # noqa: F401


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_decisions_match_brute_force(spark, trap_docs):
    rows = trap_docs.collect()
    groups = {}
    for r in rows:
        groups.setdefault(sha(r.text), []).append(r.doc_id)
    got = DigestIndex.create(spark, buckets=3).ingest(trap_docs).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = groups[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.keep_id == (max(known) if known else None)
        assert r.group_size == len(ids)
    # one row of each group stays, also where rows repeat
    kept = [r.text_sha256 for r in got if r.kept]
    assert sorted(kept) == sorted(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_later_batches_meet_the_index(spark):
    index = DigestIndex.create(spark, buckets=2)
    schema = "doc_id long, text string"
    index.ingest(spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], schema)).collect()
    second = {r.doc_id: r for r in index.ingest(
        spark.createDataFrame([(9, "a"), (8, "c"), (7, "c"), (6, "d")], schema)).collect()}
    assert [second[i].kept for i in (9, 8, 7, 6)] == [False, True, False, True]
    assert second[9].keep_id == 3
    third = index.ingest(spark.createDataFrame([(10, "d"), (11, "b")], schema)).collect()
    assert not any(r.kept for r in third)
    assert index.table().count() == 4


def test_anti_join_reads_the_buckets_without_exchange(spark):
    index = DigestIndex.create(spark, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    index.ingest(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    new = spark.range(100).selectExpr("sha2(string(id), 256) AS text_sha256")
    joined = new.hint("merge").join(index.table().select("text_sha256"), "text_sha256", "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1        # of the new data


def test_empty_batch(spark, no_docs):
    index = DigestIndex.create(spark, buckets=2)
    assert index.ingest(no_docs).collect() == []
    assert exact_dedup(no_docs).collect() == []


def test_exact_dedup_keeps_columns_and_one_row_per_text(trap_docs):
    out = exact_dedup(trap_docs)
    assert out.columns == trap_docs.columns
    rows = out.collect()
    assert sorted(sha(r.text) for r in rows) == sorted({sha(r.text) for r in trap_docs.collect()})


def test_hot_group(spark):
    rows = [(i, "same" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    got = DigestIndex.create(spark, buckets=2).ingest(
        spark.createDataFrame(rows, "doc_id long, text string")).where("text_sha256 = '%s'" % sha("same")).collect()
    assert len(got) == 1000 and {r.keep_id for r in got} == {2997} and {r.group_size for r in got} == {1000}
    assert sum(r.kept for r in got) == 1


SCHEMA = "doc_id long, text string"


def decisions(df):
    return sorted(((r.doc_id, r.keep_id, r.kept) for r in df.collect()), key=str)


def test_a_batch_run_again_decides_as_before(spark, monkeypatch):
    index = DigestIndex.create(spark, buckets=2)
    index.ingest(spark.createDataFrame([(1, "a")], SCHEMA), batch_id="first")
    batch = spark.createDataFrame([(5, "b"), (6, "b"), (7, "a"), (8, "c")], SCHEMA)
    before = decisions(index.ingest(batch, batch_id="second"))
    assert before == [(5, 6, False), (6, 6, True), (7, 1, False), (8, 8, True)]
    assert decisions(index.ingest(batch, batch_id="second")) == before
    assert index.table().count() == 3
    # a failure after a part of the append
    part = DigestIndex.create(spark, buckets=2)
    part.ingest(spark.createDataFrame([(1, "a")], SCHEMA), batch_id="first")
    append = DigestIndex._append
    with monkeypatch.context() as m:
        m.setattr(DigestIndex, "_append", lambda self, rows: (append(self, rows.limit(1)), 1 / 0))
        try:
            part.ingest(batch, batch_id="second")
        except ZeroDivisionError:
            pass
    assert part.table().count() == 2
    assert decisions(part.ingest(batch, batch_id="second")) == before and part.table().count() == 3


def test_opened_again_under_another_name(spark, tmp_path):
    path = str(tmp_path / "index")
    index = DigestIndex.create(spark, path=path, buckets=3)
    index.ingest(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA))
    index.close()
    assert not spark.catalog.tableExists(index.name)
    again = DigestIndex.open(spark, path)
    assert again.buckets == 3 and again.table().count() == 2
    assert decisions(again.ingest(spark.createDataFrame([(3, "b"), (4, "c")], SCHEMA))) == \
        [(3, 2, False), (4, 4, True)]
    try:
        DigestIndex.open(spark, str(tmp_path / "none"))
        raise AssertionError
    except FileNotFoundError:
        pass


def test_batches_by_descending_id_equal_one_batch(spark, trap_docs, no_docs):
    from stratum.llm.digest_index import by_descending_id
    for n in (1, 2, 4):
        parts = by_descending_id(trap_docs, n)
        assert sum(p.count() for p in parts) == trap_docs.count()
        got = DigestIndex.create(spark, buckets=2).ingest_all(parts)
        one = DigestIndex.create(spark, buckets=2).ingest(trap_docs)
        assert sorted(map(str, got.collect())) == sorted(map(str, one.select(got.columns).collect()))
    assert DigestIndex.create(spark, buckets=2).ingest_all(by_descending_id(no_docs, 3)).collect() == []
