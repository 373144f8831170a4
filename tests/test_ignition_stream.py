"""Ignition trips over micro-batches against a plain walk over the sorted rows."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from stratum.operators.ordered import time_chunk
from stratum.streaming.ignition import IgnitionTrips

SCHEMA = "vehicle_id long, event_id long, ts timestamp, event_type string"
START = dt.datetime(2024, 1, 1)
TIMEOUT, DELAY = 3600, 7200


def feed(n, seed, vehicles=6):
    """(vehicle, id, seconds, type): a third of all rows belongs to vehicle 0."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        vehicle = 0 if rnd.random() < 0.34 else rnd.randrange(1, vehicles)
        out.append((vehicle, i, rnd.randrange(0, 3 * 86_400) // 300 * 300, rnd.choice(["on", "off", "x", "x", "x"])))
    return out


def walk(rows):
    out, last = {}, {}
    for vehicle, i, at, kind in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        before = last.get(vehicle)
        new = before is None or before[1] == "off" or at - before[0] > TIMEOUT or kind == "on"
        start = at if new else before[2]
        out[i] = (new, start)
        last[vehicle] = (at, kind, start)
    return out


def frame(spark, rows):
    return spark.createDataFrame([(v, i, START + dt.timedelta(seconds=s), k) for v, i, s, k in rows], SCHEMA)


def trips_at(spark):
    return IgnitionTrips(spark, tempfile.mkdtemp(prefix="stratum-ignition-"), "on", "off", TIMEOUT, DELAY,
                         lambda ts: time_chunk(ts, "day"))


def seconds(ts):
    return int((ts - START).total_seconds())


def deliveries(rows, n, seed):
    """Rows out of order by less than the delay."""
    rnd = random.Random(seed)
    arrival = {r[1]: r[2] + rnd.randrange(0, DELAY) for r in rows}
    step = max(arrival.values()) // n + 1
    return [[r for r in rows if arrival[r[1]] // step == k] for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_out_of_order_micro_batches_equal_one_walk(spark, seed):
    rows = feed(400, seed)
    trips = trips_at(spark)
    for number, part in enumerate(deliveries(rows, 4, seed)):
        trips.write_batch(frame(spark, part), number)
    got = {r.event_id: (r.is_trip_start, seconds(r.trip_start)) for r in trips.rows().collect()}
    assert got == walk(rows) and trips.late().count() == 0
    final = trips.rows().where("is_final").agg(F.max("ts")).first()[0]
    assert 0 <= (max(r[2] for r in rows) - DELAY) - seconds(final) < 86_400


def test_running_a_micro_batch_again_changes_nothing(spark):
    rows = feed(150, 3)
    trips = trips_at(spark)
    for number, part in enumerate(deliveries(rows, 3, 3)):
        trips.write_batch(frame(spark, part), number)
        before = sorted(map(str, trips.rows().collect()))
        trips.write_batch(frame(spark, part), number)
        assert sorted(map(str, trips.rows().collect())) == before
    assert {r.event_id: (r.is_trip_start, seconds(r.trip_start)) for r in trips.rows().collect()} == walk(rows)


def test_a_failed_micro_batch_leaves_the_state_of_the_one_before(spark, monkeypatch):
    rows = feed(100, 4)
    trips = trips_at(spark)
    parts = deliveries(rows, 2, 4)
    trips.write_batch(frame(spark, parts[0]), 0)
    before = sorted(map(str, trips.rows().collect()))
    with monkeypatch.context() as m:
        m.setattr(IgnitionTrips, "_trips", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            trips.write_batch(frame(spark, parts[1]), 1)
    assert sorted(map(str, trips.rows().collect())) == before
    trips.write_batch(frame(spark, parts[1]), 1)
    assert {r.event_id: (r.is_trip_start, seconds(r.trip_start)) for r in trips.rows().collect()} == walk(rows)


def test_late_rows_timeouts_and_an_empty_batch(spark):
    trips = trips_at(spark)
    trips.write_batch(frame(spark, [(1, 1, 0, "on"), (1, 2, 600, "x"), (2, 3, 600, "on"), (2, 4, 900, "off")]), 0)
    assert trips.ended_trips().count() == 0                                 # nothing is due yet
    trips.write_batch(frame(spark, [(3, 5, 20_000, "x"), (None, 6, 19_000, "x")]), 1)
    ended = {(r.vehicle_id, r.n_events, r.ended_by) for r in trips.ended_trips().collect()}
    assert ended == {(1, 2, "timeout"), (2, 2, "off")}                      # the watermark is at 12,800
    trips.write_batch(frame(spark, [(1, 7, 300, "x"), (1, 8, 12_900, "x")]), 2)
    assert [r.event_id for r in trips.late().collect()] == [7]
    trips.write_batch(frame(spark, []), 3)
    got = {r.event_id: (r.is_trip_start, seconds(r.trip_start)) for r in trips.rows().collect()}
    assert got == {1: (True, 0), 2: (False, 0), 3: (True, 600), 4: (False, 600), 5: (True, 20_000),
                   6: (True, 19_000), 8: (True, 12_900)}
    unplaced = spark.createDataFrame([(1, 9, None, "x")], SCHEMA)
    trips.write_batch(unplaced, 4)
    assert sorted(r.event_id for r in trips.late().collect()) == [7, 9]


def test_a_trip_spans_micro_batches_and_is_counted_once(spark):
    trips = trips_at(spark)
    for number in range(4):
        rows = [(1, number * 10 + i, number * 9000 + i * 900, "on" if number == i == 0 else "x") for i in range(10)]
        trips.write_batch(frame(spark, rows), number)
    trips.write_batch(frame(spark, [(2, 99, 90_000, "x")]), 4)
    ended = trips.ended_trips().collect()
    assert [(r.vehicle_id, r.n_events, r.ended_by, seconds(r.trip_end)) for r in ended] == [(1, 40, "timeout", 35_100)]
