"""Date and timestamp column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The calendar's text format for date_key.
DATE_KEY_FORMAT = "dd-MM-yyyy"


def as_timestamp(col: str | Column, dtype: T.DataType | None = None) -> Column:
    """Timestamp from text, NTZ or timestamp input; bad text gives null (ANSI-safe)."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast(T.TimestampType())
    return F.try_to_timestamp(c.cast(T.StringType()))


def order_date(ts: str | Column) -> Column:
    """Calendar date of a timestamp in the session time zone (UTC)."""
    return F.to_date(ts)


def parse_date_key(col: str | Column, fmt: str = DATE_KEY_FORMAT) -> Column:
    """``dd-MM-yyyy`` text to date; text in any other layout gives null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_date(c.cast(T.StringType()), fmt)


def to_utc(ts: str | Column, source_tz: str | Column) -> Column:
    """Normalise a wall-clock timestamp recorded in ``source_tz`` to UTC."""
    tz = F.lit(source_tz) if isinstance(source_tz, str) else source_tz
    return F.to_utc_timestamp(ts, tz)


def week_ending_sunday(d: str | Column) -> Column:
    """Label of the Sunday-ending week holding ``d``; a Sunday labels itself."""
    return F.next_day(F.date_sub(d, 1), "Sun")


def month_end(d: str | Column) -> Column:
    """Month-end label of the month holding ``d``."""
    return F.last_day(d)
