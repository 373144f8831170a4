"""Surrogate keys and deterministic seeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols, sep: str = "|") -> Column:
    """Content hash key: sha2-256 of the fields joined by ``sep``.

    Every field is rendered as string and NULL becomes ``''`` first, so the
    key is total and identical to DuckDB ``sha256(concat_ws(...))``.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.sha2(F.concat_ws(sep, *parts), 256)


def portable_seed(c) -> Column:
    """Non-negative 32-bit seed: the first 8 hex digits of ``md5(c)``.

    Portable across engines (DuckDB: ``('0x'||md5(c)[1:8])::BIGINT``), never
    negative, so plain ``%`` is a proper modulus.
    """
    return F.conv(F.substring(F.md5(_col(c).cast("string")), 1, 8), 16, 10).cast("bigint")


def murmur_seed(c) -> Column:
    """Spark Murmur3 ``hash`` widened to bigint and made non-negative.

    ``abs(hash(x))`` overflows for INT_MIN; working in bigint avoids it.
    Use with ``F.pmod`` for bucket numbers.
    """
    return F.abs(F.hash(_col(c)).cast("bigint"))


def bucket(c, n: int, seed_fn=portable_seed) -> Column:
    """Deterministic bucket ``0..n-1`` of a value."""
    return F.pmod(seed_fn(c), F.lit(n))
