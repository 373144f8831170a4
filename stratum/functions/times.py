"""Time arithmetic that does not depend on the session time zone.

Event times here are ``timestamp_ntz`` (wall clock).  Casting them to
``timestamp`` interprets them in the session zone, and across a daylight
saving change a 2-hour wall-clock gap becomes 1 or 3 hours.  These helpers
compute on the wall clock itself.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_between(start, end) -> Column:
    """``end - start`` in microseconds (wall clock for NTZ inputs)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of an NTZ wall-clock time."""
    return micros_between(epoch_ntz(), _c(ts))


def ntz_to_instant(ts) -> Column:
    """NTZ wall clock -> TIMESTAMP instant, read as UTC whatever the session
    zone (exact; needed where Spark requires TIMESTAMP, e.g. watermarks)."""
    return F.timestamp_micros(epoch_micros(ts))


def instant_to_ntz(ts) -> Column:
    """Inverse of ``ntz_to_instant``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), epoch_ntz())
