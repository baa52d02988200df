"""Column expressions: dates, text, flags, rounding and portable hashing."""

from lateparcel.functions.columns import (
    absolute_gap,
    clean_city,
    clean_state,
    floored_days,
    half_even,
    item_value,
    late_flag,
    lenient_number,
    mean_pm_std,
    params_column,
    params_text,
    relative_gap,
    repeat_flag,
    strict_timestamp,
    lenient_timestamp,
    trimmed,
    year_month,
)
from lateparcel.functions.hashing import hash_below_fraction, portable_hash

__all__ = [
    "absolute_gap",
    "clean_city",
    "clean_state",
    "floored_days",
    "half_even",
    "hash_below_fraction",
    "item_value",
    "late_flag",
    "lenient_number",
    "lenient_timestamp",
    "mean_pm_std",
    "params_column",
    "params_text",
    "portable_hash",
    "relative_gap",
    "repeat_flag",
    "strict_timestamp",
    "trimmed",
    "year_month",
]
