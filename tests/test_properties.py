"""Property tests: the custom operators against brute force on random
small fixtures (random keys incl. a hot one, random chunk widths, ties
broken by id, NULL values)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.operators.joins import asof_join, interval_join
from stratum.operators.sessions import sessionize

T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

events = st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]),
                            st.integers(0, 500)), min_size=1, max_size=40)


def _ts(m):
    return T0 + dt.timedelta(minutes=m)


@SETTINGS
@given(rows=events, gap=st.integers(1, 60), chunk_min=st.sampled_from([7, 30, 240]))
def test_sessionize_matches_brute_force(spark, rows, gap, chunk_min):
    data = [(k, i, _ts(m)) for i, (k, m) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, id int, ts timestamp_ntz")
    chunk = F.floor(F.timestamp_diff("MINUTE", F.lit(T0).cast("timestamp_ntz"), F.col("ts")) / chunk_min)
    got = {r["id"]: r["trip_start"] for r in sessionize(df, ["k"], "ts", "id", chunk, gap_seconds=gap * 60).collect()}
    want = {}
    for k in {r[0] for r in data}:
        prev, start = None, None
        for _, i, ts in sorted((r for r in data if r[0] == k), key=lambda r: (r[2], r[1])):
            if prev is None or (ts - prev).total_seconds() > gap * 60:
                start = ts
            want[i] = start
            prev = ts
    assert got == want


@SETTINGS
@given(left=events, right=st.lists(st.tuples(st.sampled_from(["hot", "a", "c"]), st.integers(0, 500),
                                              st.one_of(st.none(), st.integers(0, 9))), max_size=40),
       tol=st.one_of(st.none(), st.integers(1, 120)))
def test_asof_matches_brute_force(spark, left, right, tol):
    ldata = [(k, i, _ts(m)) for i, (k, m) in enumerate(left)]
    rdata = [(k, 1000 + j, _ts(m), v) for j, (k, m, v) in enumerate(right)]
    ldf = spark.createDataFrame(ldata, "k string, lid int, lts timestamp_ntz")
    rdf = spark.createDataFrame(rdata, "k string, rid int, rts timestamp_ntz, v int")
    out = asof_join(ldf, rdf, ["k"], "lts", "rts", ["rid", "v"], right_tie="rid",
                    tolerance_seconds=None if tol is None else tol * 60, chunk_unit="hour")
    got = {r["lid"]: (r["r_rid"], r["r_v"]) for r in out.collect()}
    want = {}
    for k, lid, lts in ldata:
        cands = [r for r in rdata if r[0] == k and r[2] <= lts]
        best = max(cands, key=lambda r: (r[2], r[1])) if cands else None
        if best is not None and tol is not None and (lts - best[2]).total_seconds() > tol * 60:
            best = None
        want[lid] = (best[1], best[3]) if best else (None, None)
    assert got == want


@SETTINGS
@given(left=events, right=events, before=st.integers(1, 90), after=st.integers(0, 30))
def test_interval_join_matches_brute_force(spark, left, right, before, after):
    ldata = [(k, i, _ts(m)) for i, (k, m) in enumerate(left)]
    rdata = [(k, 1000 + j, _ts(m)) for j, (k, m) in enumerate(right)]
    ldf = spark.createDataFrame(ldata, "k string, lid int, lts timestamp_ntz")
    rdf = spark.createDataFrame(rdata, "k string, rid int, rts timestamp_ntz")
    got = sorted((r["lid"], r["rid"]) for r in
                 interval_join(ldf, rdf, ["k"], "lts", "rts", before * 60, after * 60).collect())
    want = sorted((lid, rid) for k, lid, lts in ldata for k2, rid, rts in rdata
                  if k == k2 and lts - dt.timedelta(minutes=before) <= rts <= lts + dt.timedelta(minutes=after))
    assert got == want
