"""Column-returning helpers (JVM-side expressions only, no UDFs)."""

from stratum.functions.dates import month_number, parse_date_multi, safe_make_date
from stratum.functions.flags import flag_in, flag_upper_equals
from stratum.functions.keys import portable_seed, murmur_seed, surrogate_key
from stratum.functions.money import AMOUNT, to_amount

__all__ = [
    "AMOUNT", "flag_in", "flag_upper_equals", "month_number", "murmur_seed",
    "parse_date_multi", "portable_seed", "safe_make_date", "surrogate_key",
    "to_amount",
]
