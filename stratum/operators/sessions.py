"""Trip sessionization (STR6 gap-based, STR7 ignition-based), batch form.

A trip is identified by ``(key, trip_start)``: the timestamp of its first
event, carried forward with the skew-safe ``fill_forward`` scan, so no
global cumulative counter is needed.  A gap *equal* to the limit does not
split a trip (same rule as ``session_window``: next <= prev + gap merges).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.times import micros_between
from stratum.operators.ordered import fill_forward, neighbour


def sessionize(df: DataFrame, keys: Sequence[str], ts: str, tie: str, chunk: Column,
               gap_seconds: int | None = None, start_when: Column | None = None,
               end_when: Column | None = None, carry: Sequence[str] = (),
               out: str = "trip_start", known: Column | None = None) -> DataFrame:
    """Assign each row the start timestamp of its trip.

    A row starts a new trip if it is the key's first row, or the time since
    the previous row exceeds ``gap_seconds`` (also the "lost ignition-off"
    timeout), or ``start_when`` holds on it, or ``end_when`` held on the
    previous row.  ``carry`` columns of the previous row are exposed as
    ``prev_<c>`` (e.g. positions for step distances) together with the
    boolean ``is_trip_start``.  Where ``known`` isn't NULL, the row belongs to
    the trip that began then (an open trip carried over from an earlier scan).
    """
    df = df.withColumn("__end", end_when if end_when is not None else F.lit(False))
    p = neighbour(df, keys, [ts, tie], chunk, carry=[ts, "__end", *carry],
                  direction="prev", keep_chunk=True)
    new = F.col(f"prev_{ts}").isNull() | F.col("prev___end")
    if gap_seconds is not None:
        new = new | (micros_between(f"prev_{ts}", ts) > F.lit(gap_seconds * 1_000_000))
    if start_when is not None:
        new = new | start_when
    start = F.when(new, F.col(ts))
    p = p.withColumn("is_trip_start", new).withColumn(out, start if known is None else F.coalesce(known, start))
    res = fill_forward(p, keys, [ts, tie], F.col("__chunk"), [out])
    return res.drop("__end", "prev___end", f"prev_{ts}")
