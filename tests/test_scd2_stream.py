"""Local repair of type-2 histories against a recomputation from all changes."""

import random
import tempfile

import pytest

from stratum.streaming.scd2_stream import Scd2Snapshot
from pyspark.sql import functions as F


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, at long, tie long, v string")


def history(changes):
    """(k, v, from, to, tie) of all distinct changes."""
    out, by_key = set(), {}
    for c in set(changes):
        by_key.setdefault(c[0], []).append(c)
    for k, own in by_key.items():
        own.sort(key=lambda c: (c[1], c[2]))
        for c, after in zip(own, [*own[1:], None]):
            out.add((k, c[3], c[1], after[1] if after else None, c[2]))
    return out


def stored(snapshot):
    return {(r.k, r.v, r.effective_from, r.effective_to, r.tie) for r in snapshot.read().collect()}


@pytest.fixture()
def snapshot(spark):
    return Scd2Snapshot(spark, tempfile.mkdtemp(prefix="stratum-scd2-"), ["k"], ["at", "tie"], ["v"],
                        lambda: F.floor(F.col("at") / 10), 3)


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_in_any_order_equal_a_recomputation(spark, snapshot, seed):
    rnd = random.Random(seed)
    everything = [(None if rnd.random() < 0.05 else rnd.choice([1, 1, 1, 2, 3, 4]), rnd.randrange(60), i,
                   rnd.choice(["a", "b", None])) for i in range(120)]
    seen = []
    for step in range(5):
        part = everything[step * 24:(step + 1) * 24] + rnd.sample(seen, min(5, len(seen)))      # some come again
        seen += part
        snapshot.write_batch(frame(spark, part))
        assert stored(snapshot) == history(seen)
        assert snapshot.read().count() == len(set(seen))


def test_late_first_between_and_last(spark, snapshot):
    seen = [(1, 10, 0, "a"), (1, 30, 0, "c")]
    for more in ([(1, 20, 0, "b")], [(1, 5, 0, "z")], [(1, 40, 0, "d")], [(1, 1, 0, "y"), (1, 50, 0, "e")],
                 [(2, 7, 0, "n")], [(1, 20, 0, "b")]):
        snapshot.write_batch(frame(spark, seen))
        seen = seen + more
        snapshot.write_batch(frame(spark, more))
        assert stored(snapshot) == history(seen)


def test_only_the_neighbours_of_a_change_are_written(spark, snapshot, monkeypatch):
    snapshot.write_batch(frame(spark, [(k, at, 0, "x") for k in range(6) for at in range(0, 400, 4)]))
    taken = []
    merge = type(snapshot.table).merge
    monkeypatch.setattr(type(snapshot.table), "merge", lambda self, rows: (taken.append(rows.count()), merge(self, rows)))
    snapshot.write_batch(frame(spark, [(2, 201, 0, "y")]))
    assert taken == [2]                     # the new version and the one before it
    snapshot.write_batch(frame(spark, [(2, 201, 0, "y")]))
    assert taken == [2, 0] and snapshot.read().count() == 601
    snapshot.write_batch(frame(spark, []))
    assert taken == [2, 0]


def test_a_failed_merge_leaves_the_snapshot(spark, snapshot, monkeypatch):
    from stratum import sinks
    seen = [(1, 10, 0, "a"), (1, 30, 0, "c")]
    snapshot.write_batch(frame(spark, seen))
    with monkeypatch.context() as m:
        m.setattr(sinks, "create_text_file", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            snapshot.write_batch(frame(spark, [(1, 20, 0, "b")]))
    assert stored(snapshot) == history(seen)
    snapshot.write_batch(frame(spark, [(1, 20, 0, "b")]))
    assert stored(snapshot) == history(seen + [(1, 20, 0, "b")])


def test_keys_of_a_large_batch_do_not_pass_through_the_driver(spark, snapshot):
    snapshot.write_batch(frame(spark, [(1, 10, 0, "a"), (2, 10, 0, "a")]))
    changes = frame(spark, [(1, 20, 0, "b"), (2, 5, 0, "c")])
    plans = [snapshot._repaired(changes, snapshot.table.buckets_of(changes), small)
             ._jdf.queryExecution().executedPlan().toString() for small in (True, False)]
    assert "BroadcastHashJoin [__k" in plans[0] and "BroadcastHashJoin [__k" not in plans[1]
    assert snapshot.table.broadcast_bytes <= 1 << 20
