"""Bucket arithmetic: exact NTILE from a global position, equal-width bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntile_from_position(pos: Column, n: Column, k: int) -> Column:
    """Bucket of 1-based position ``pos`` among ``n`` rows split into ``k`` tiles.

    Same rule as SQL NTILE: the first ``n mod k`` tiles hold one extra row.
    """
    q = F.floor(n / F.lit(k)).cast("long")
    r = (n % F.lit(k)).cast("long")
    big = r * (q + 1)
    return (F.when(q == 0, pos)
            .when(pos <= big, F.floor((pos - 1) / (q + 1)) + 1)
            .otherwise(r + F.floor((pos - 1 - big) / q) + 1)).cast("long")


def equal_width_bin(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """1..bins equal-width bin of value in [lo, hi]; the maximum falls in the last bin,
    and a constant column (lo == hi) puts everything in bin 1."""
    width = (hi - lo).cast("double") / F.lit(bins)
    raw = F.floor((value - lo).cast("double") / width).cast("long") + 1
    return F.when(hi == lo, F.lit(1).cast("long")).otherwise(F.least(raw, F.lit(bins).cast("long")))
