"""A hash order that gives the same rows on any engine, partitioning or retry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def portable_hash(keys: Sequence[str], seed: int = 42) -> Column:
    """md5 hex of ``seed|key|key…``: stands in for a seeded random number per row."""
    # a null key is marked, so that (null, a) and (a, null) differ
    parts = [F.coalesce(F.col(key).cast("string"), F.lit("\x00")) for key in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def hash_below_fraction(hashed: Column, fraction: float) -> Column:
    """True for about ``fraction`` of all hashes, decided row by row."""
    limit = format(int(fraction * 2**32), "08x")
    return F.substring(hashed, 1, 8) < F.lit(limit)
