"""Numeric coercion and safe ratio expressions (no errors under ANSI)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: str | Column) -> Column:
    """Double from any input; unparsable text gives null."""
    return _col(c).cast(T.StringType()).try_cast(T.DoubleType())


def to_number_or_zero(c: str | Column) -> Column:
    return F.coalesce(to_number(c), F.lit(0.0))


def as_double(c: str | Column) -> Column:
    return _col(c).cast(T.DoubleType())


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den in double precision; null when den is 0 or null."""
    return F.try_divide(as_double(num), as_double(den))


def pct_change(new: str | Column, base: str | Column) -> Column:
    """(new - base) / base * 100; null when base is 0 or null."""
    return F.try_divide(as_double(_col(new) - _col(base)), as_double(base)) * F.lit(100.0)
