"""Label, boolean and text-format expressions used by reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text spellings read as loyalty flags, and their labels.
TRUE_TEXT = ("true", "1")
FALSE_TEXT = ("false", "0")
MEMBER_LABEL = "Loyalty Member"
NON_MEMBER_LABEL = "Non-Member"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_bool(c: str | Column) -> Column:
    """Boolean from bool, 0/1 or text (``True``/``true``/``1`` …); anything else null."""
    text = F.lower(_col(c).cast(T.StringType()))
    return (F.when(text.isin(*TRUE_TEXT), F.lit(True))
            .when(text.isin(*FALSE_TEXT), F.lit(False)))


def loyalty_label(c: str | Column) -> Column:
    b = normalise_bool(c)
    return F.when(b, F.lit(MEMBER_LABEL)).when(~b, F.lit(NON_MEMBER_LABEL))


def money(c: str | Column) -> Column:
    """``$1,234,567.50`` — dollar sign, thousands separators, two decimals."""
    v = _col(c)
    return F.when(v.isNotNull(),
                  F.concat(F.when(v < 0, F.lit("-$")).otherwise(F.lit("$")),
                           F.format_number(F.abs(v).cast("double"), 2)))
