import datetime as dt

from pyspark.sql import functions as F

from stratum.operators.joins import asof_join, bridge, interval_join, point_in_time
from stratum.operators.ordered import time_chunk
from stratum.operators.sessions import sessionize


def ts(h, m=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h, minutes=m)


def test_gap_sessions_equal_gap_merges(spark):
    rows = [("v", 1, ts(0)), ("v", 2, ts(1)), ("v", 3, ts(3)),      # gap 2h == limit: same trip
            ("v", 4, ts(5, 1)),                                     # gap 2h01: new trip
            ("w", 5, ts(9))]                                        # single point
    df = spark.createDataFrame(rows, "k string, id int, ts timestamp_ntz").orderBy(F.rand(3))
    s = sessionize(df, ["k"], "ts", "id", time_chunk("ts", "hour"), gap_seconds=7200)
    got = {r["id"]: r["trip_start"] for r in s.collect()}
    assert got == {1: ts(0), 2: ts(0), 3: ts(0), 4: ts(5, 1), 5: ts(9)}


def test_ignition_sessions_with_lost_off(spark):
    rows = [("v", 1, ts(0), "on"), ("v", 2, ts(0, 10), "drive"), ("v", 3, ts(0, 20), "off"),
            ("v", 4, ts(0, 30), "drive"),                          # after off: new trip
            ("v", 5, ts(1), "on"), ("v", 6, ts(9), "drive")]       # lost off, timeout
    df = spark.createDataFrame(rows, "k string, id int, ts timestamp_ntz, e string")
    s = sessionize(df, ["k"], "ts", "id", time_chunk("ts", "hour"), gap_seconds=3 * 3600,
                   start_when=F.col("e") == "on", end_when=F.col("e") == "off")
    got = {r["id"]: r["trip_start"] for r in s.collect()}
    assert got == {1: ts(0), 2: ts(0), 3: ts(0), 4: ts(0, 30), 5: ts(1), 6: ts(9)}


def test_asof_ties_and_tolerance(spark):
    left = spark.createDataFrame([("v", 10, ts(1)), ("v", 11, ts(2)), ("v", 12, ts(9)), ("u", 13, ts(1))],
                                 "k string, lid int, lts timestamp_ntz")
    right = spark.createDataFrame([("v", 1, ts(1), 5.0), ("v", 2, ts(1, 30), None), ("v", 3, ts(0), 7.0)],
                                  "k string, rid int, rts timestamp_ntz, val double")
    out = asof_join(left, right, ["k"], "lts", "rts", ["rid", "val"], right_tie="rid",
                    tolerance_seconds=3600, chunk_unit="hour")
    got = {r["lid"]: (r["r_rid"], r["r_val"]) for r in out.collect()}
    # same-instant right row counts; NULL value is carried as NULL (not
    # back-filled); stale beyond tolerance -> NULL; no key -> NULL
    assert got == {10: (1, 5.0), 11: (2, None), 12: (None, None), 13: (None, None)}


def test_point_in_time(spark):
    dim = spark.createDataFrame([("p", "a", ts(0), ts(5)), ("p", "b", ts(5), None)],
                                "k string, tier string, effective_from timestamp_ntz, effective_to timestamp_ntz")
    fact = spark.createDataFrame([("p", 1, ts(4, 59)), ("p", 2, ts(5)), ("p", 3, ts(-1))],
                                 "k string, id int, at timestamp_ntz")
    got = {r["id"]: r["tier"] for r in point_in_time(fact, dim, ["k"], "at", ["tier"]).collect()}
    assert got == {1: "a", 2: "b", 3: None}


def test_interval_join_bounds(spark):
    left = spark.createDataFrame([("v", 1, ts(1))], "k string, lid int, lts timestamp_ntz")
    right = spark.createDataFrame([("v", r, t) for r, t in
                                   [(1, ts(0, 29)), (2, ts(0, 30)), (3, ts(1)), (4, ts(1, 1))]],
                                  "k string, rid int, rts timestamp_ntz")
    got = sorted(r["rid"] for r in interval_join(left, right, ["k"], "lts", "rts", 1800).collect())
    assert got == [2, 3]


def test_bridge_is_total_and_deterministic(spark):
    left = spark.range(500).select(F.col("id").alias("cust"))
    right = spark.range(37).select((F.col("id") * 11).alias("veh"))
    b = bridge(left, "cust", right, "veh")
    assert b.count() == 500 and b.where("veh IS NULL").count() == 0
    assert sorted(b.collect(), key=repr) == sorted(bridge(left.repartition(3), "cust", right, "veh").collect(), key=repr)


def test_gaps_are_wall_clock_under_a_dst_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = [("v", 1, dt.datetime(2024, 3, 10, 1, 30)), ("v", 2, dt.datetime(2024, 3, 10, 3, 30))]
        df = spark.createDataFrame(rows, "k string, id int, ts timestamp_ntz")
        s = sessionize(df, ["k"], "ts", "id", time_chunk("ts", "hour"), gap_seconds=7200)
        assert {r["id"]: r["trip_start"] for r in s.collect()} == {1: rows[0][2], 2: rows[0][2]}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_null_keys_match_nothing_in_asof_and_point_in_time(spark):
    left = spark.createDataFrame([(None, 5), ("a", 5)], "k string, s long") \
        .selectExpr("k", "timestamp_seconds(s) AS lts")
    right = spark.createDataFrame([(None, 1, "n"), ("a", 1, "v")], "k string, s long, x string") \
        .selectExpr("k", "timestamp_seconds(s) AS rts", "x")
    got = {r.k: r.r_x for r in asof_join(left, right, ["k"], "lts", "rts", ["x"]).collect()}
    assert got == {None: None, "a": "v"}
    dim = right.selectExpr("k", "rts AS effective_from", "CAST(NULL AS timestamp) AS effective_to", "x")
    got = {r.k: r.x for r in point_in_time(left, dim, ["k"], "lts", ["x"]).collect()}
    assert got == {None: None, "a": "v"}
