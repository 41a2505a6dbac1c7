"""Calendar helpers."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType


def wall_clock(value: date | datetime | str) -> str:
    """The value as text, free of any time zone."""
    return value if isinstance(value, str) else str(value)


def bound(value: date | datetime | str, kind: DataType) -> Column:
    """A time to compare a column of type ``kind`` with.

    A value without a zone is a wall-clock time of the session's zone, whatever the zone of
    this process. A day keeps a date column as it is, so the filter reaches the scan.
    """
    if isinstance(value, datetime) and value.tzinfo is not None:
        return F.lit(value)
    text = wall_clock(value)
    if isinstance(kind, TimestampType):
        return F.lit(text).cast("timestamp")
    if isinstance(kind, (DateType, TimestampNTZType)):
        return F.lit(text).cast("date" if isinstance(kind, DateType) and len(text) <= 10 else "timestamp_ntz")
    return F.lit(text)


def day_of(value: date | datetime | str) -> Column:
    """The calendar day of a wall-clock time."""
    return F.lit(wall_clock(value)[:10]).cast("date")


def week_block(day: Column) -> Column:
    """Week of the year counted in 7-day blocks from 1 January (1 to 53)."""
    return F.floor((F.dayofyear(day) - 1) / 7).cast("int") + 1


def week_label(day: Column) -> Column:
    """``yyyy_w`` label of the 7-day block."""
    return F.concat_ws("_", F.year(day), week_block(day))


def week_start(day: Column) -> Column:
    """First day of the 7-day block, which sorts weeks in time order."""
    return F.date_sub(day, ((F.dayofyear(day) - 1) % 7).cast("int"))


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_day(day: Column) -> Column:
    return F.date_format(day, "MM-dd")


def compact_date(text: Column) -> Column:
    """``yyyy-MM-dd`` written as ``yyyyMMdd``."""
    return F.regexp_replace(text.cast("string"), "-", "")


def parse_timestamp(text: Column) -> Column:
    """Timestamp from text that may carry a trailing zone name ``CST``."""
    return F.try_to_timestamp(F.regexp_replace(text, r"\sCST$", ""))
