"""Money: decimal(14,2) end to end."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

AMOUNT = DecimalType(14, 2)


def to_amount(c) -> Column:
    """Cast to decimal(14,2); unparseable or overflowing input gives NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast(AMOUNT)
