"""The stored table that batches are merged into: commits, failures, reuse of buckets."""

import os
import tempfile

import pytest

from stratum import sinks
from stratum.sinks import MergeConflict, MergeTable


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="stratum-merge-")


def rows(spark, *r):
    return spark.createDataFrame(list(r), "k long, seq long, v string")


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_latest_wins_and_ties_keep_the_stored_row(spark, root):
    table = MergeTable(spark, root, ["k"], ["seq"], buckets=4)
    assert table.read() is None
    table.merge(rows(spark, (1, 1, "a"), (2, 5, "b"), (None, 1, "n")))
    table.merge(rows(spark, (1, 2, "c"), (1, 1, "x"), (2, 4, "old"), (3, 1, "n"), (None, 2, "m")))
    want = sorted([(1, 2, "c"), (2, 5, "b"), (3, 1, "n"), (None, 2, "m")], key=str)
    assert content(table.read()) == want
    assert content(table.merge(rows(spark, (1, 2, "c"), (2, 5, "b")))) == want          # replay


def test_update_wins_without_a_sequence(spark, root):
    table = MergeTable(spark, root, ["k"], buckets=3)
    table.merge(rows(spark, (1, 9, "a"), (2, 9, "b")))
    assert content(table.merge(rows(spark, (1, 1, "z")))) == [(1, 1, "z"), (2, 9, "b")]
    assert content(table.merge(rows(spark).limit(0))) == [(1, 1, "z"), (2, 9, "b")]      # empty batch


@pytest.mark.parametrize("broadcast_bytes", [0, 64 << 20])
def test_equals_a_full_recomputation(spark, root, broadcast_bytes):
    table = MergeTable(spark, root, ["k"], ["seq"], buckets=5, broadcast_bytes=broadcast_bytes, max_files=2)
    state = {}
    for step in range(6):
        batch = [((i * 7 + step) % 40, (i * 13 + step * 5) % 23, f"{step}.{i}") for i in range(25)]
        best = {}
        for k, s, v in batch:
            best[k] = max(best.get(k, (s, v)), (s, v))
        for k, (s, v) in best.items():
            if k not in state or state[k][0] < s:
                state[k] = (s, v)
        got = table.merge(rows(spark, *batch))
        assert content(got) == sorted(((k, s, v) for k, (s, v) in state.items()), key=str)


@pytest.mark.parametrize("step", ["staged", "merged", "commit", "cut"])
def test_failure_between_any_two_steps_leaves_the_table(spark, root, monkeypatch, step):
    table = MergeTable(spark, root, ["k"], ["seq"], buckets=4)
    table.merge(rows(spark, *[(i, 1, "old") for i in range(10)]))
    before = content(table.read())
    update = rows(spark, *[(i, 2, "new") for i in range(5, 12)])

    def fail(*_):
        raise OSError("lost")
    with monkeypatch.context() as m:
        if step == "staged":
            m.setattr(MergeTable, "_merged", fail)
        elif step == "merged":
            m.setattr(sinks, "files_in", fail)
        elif step == "commit":
            m.setattr(sinks, "create_text_file", fail)
        else:                       # the manifest was cut short while it was written
            def half(spark_, path, text):
                sinks_create(spark_, path, text[:len(text) // 2])
                raise OSError("lost")
            sinks_create = sinks.create_text_file
            m.setattr(sinks, "create_text_file", half)
        with pytest.raises(OSError):
            table.merge(update)
    assert content(table.read()) == before and table.version() == 1
    again = MergeTable(spark, root, ["k"], ["seq"])             # opened anew
    assert again.buckets == 4
    want = sorted([(i, 1, "old") for i in range(5)] + [(i, 2, "new") for i in range(5, 12)], key=str)
    assert content(again.merge(update)) == want


def test_a_second_writer_conflicts(spark, root, monkeypatch):
    one, two = (MergeTable(spark, root, ["k"], ["seq"], buckets=2) for _ in range(2))
    one.merge(rows(spark, (1, 1, "a")))
    merged = MergeTable._merged

    def meanwhile(self, *args):
        monkeypatch.setattr(MergeTable, "_merged", merged)
        two.merge(rows(spark, (1, 2, "two")))
        return merged(self, *args)
    monkeypatch.setattr(MergeTable, "_merged", meanwhile)
    with pytest.raises(MergeConflict):
        one.merge(rows(spark, (1, 3, "one")))
    assert content(one.read()) == [(1, 2, "two")]
    assert content(one.merge(rows(spark, (1, 3, "one")))) == [(1, 3, "one")]


def data_files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{root}/data") for f in names if f.endswith(".parquet")}


def test_only_touched_buckets_are_written_and_vacuum_deletes_the_rest(spark, root):
    table = MergeTable(spark, root, ["k"], ["seq"], buckets=100)
    everything = spark.range(5000).selectExpr("id AS k", "1L AS seq", "'a' AS v")
    table.merge(everything)
    first = data_files(root)
    assert len(first) == 100
    one = everything.selectExpr("k", "2L AS seq", "'b' AS v", "pmod(xxhash64(k), 100) AS b").where("b = 7").drop("b")
    n = one.count()
    table.merge(one)
    new = data_files(root) - first
    assert {f.split("__bucket=")[1].split("/")[0] for f in new} == {"7"} and len(new) <= 4
    assert table.read().where("v = 'b'").count() == n and table.read().count() == 5000
    assert table.read(1).where("v = 'b'").count() == 0          # the earlier version is still there
    assert table.vacuum() >= 1
    assert content(table.read().where("v = 'b'").selectExpr("count(*)")) == [(n,)]
    assert table.read().count() == 5000
    assert table.vacuum() == 0


def test_small_updates_leave_the_stored_side_unshuffled(spark, root):
    table = MergeTable(spark, root, ["k"], ["seq"], buckets=4)
    table.merge(rows(spark, *[(i, 1, "old") for i in range(50)]))
    stored = table._bucketed(table.read())
    plan = table._merged(stored, table._bucketed(rows(spark, (1, 2, "n"))), root)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_files_of_a_bucket_stay_few(spark, root):
    table = MergeTable(spark, root, ["k"], ["seq"], buckets=1, max_files=3)
    for i in range(9):
        table.merge(rows(spark, (i, 1, "a")))
    table.vacuum()
    assert len(data_files(root)) <= 5 and table.read().count() == 9


def test_evolving_columns(spark, root):
    table = MergeTable(spark, root, ["k"], ["seq"], buckets=2, evolving=True)
    table.merge(rows(spark, (1, 1, "a"), (2, 1, "b")))
    wide = spark.createDataFrame([(2, 2, "c", 9)], "k long, seq long, v string, extra int")
    got = {(r.k, r.v, r.extra) for r in table.merge(wide).collect()}
    assert got == {(1, "a", None), (2, "c", 9)}


def test_many_updates_that_win_shuffle_the_stored_rows_once(spark, root, monkeypatch):
    table = MergeTable(spark, root, ["k", "seq"], buckets=3, broadcast_bytes=0, bucket_by=["k"])
    table.merge(rows(spark, (1, 1, "a"), (1, None, "b"), (None, 2, "c"), (2, 2, None), (3, 3, "e")))
    plans, write = [], MergeTable._write

    def spy(self, df, folder):
        plans.append((folder, df._jdf.queryExecution().executedPlan().toString()))
        return write(self, df, folder)

    monkeypatch.setattr(MergeTable, "_write", spy)
    got = table.merge(rows(spark, (1, None, "B"), (None, 2, None), (2, 2, "d"), (4, 4, "f")))
    want = [(1, 1, "a"), (1, None, "B"), (None, 2, None), (2, 2, "d"), (3, 3, "e"), (4, 4, "f")]
    assert content(got) == sorted(want, key=str)
    merged = [plan for folder, plan in plans if folder.startswith("v-")]
    assert len(merged) == 1 and merged[0].count("Exchange hashpartitioning") == 1 and "Join" not in merged[0]
