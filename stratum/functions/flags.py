"""Boolean flag parsing for heterogeneous source encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings a "yes/no" style source uses for true.
TRUTHY = ("1", "yes", "y", "true")


def flag_upper_equals(c, token: str = "Y") -> Column:
    """Strict rule: ``upper(x) = token``; no trimming, NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.upper(c) == F.lit(token.upper())


def flag_in(c, values=TRUTHY) -> Column:
    """Lenient rule: ``lower(trim(x))`` in the accepted spellings.

    NULL input gives NULL (three-valued), matching SQL ``IN``.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.trim(c)).isin(*[v.lower() for v in values])
