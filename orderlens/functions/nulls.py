"""Null rules of the reports, where they differ from SQL's three-valued logic."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_in(column: Column, values: Iterable) -> Column:
    """Membership that is never NULL: a NULL value is simply not a member."""
    return F.coalesce(column.isin(*values), F.lit(False))


def not_in(column: Column, values: Iterable) -> Column:
    """Complement of :func:`is_in`; keeps rows whose value is NULL."""
    return ~is_in(column, values)


def holds(condition: Column) -> Column:
    """``condition`` with unknown read as false."""
    return F.coalesce(condition, F.lit(False))


def flag(condition: Column) -> Column:
    """1 where ``condition`` holds, else 0 (also when it is unknown)."""
    return holds(condition).cast("int")


def count_rows() -> Column:
    return F.count(F.lit(1))


def count_distinct_na(column: Column, where: Column | None = None) -> Column:
    """Distinct values, with NULL counted as one value, over rows ``where``."""
    if where is None:
        return F.count_distinct(column) + F.coalesce(F.max(flag(column.isNull())), F.lit(0))
    null_seen = F.max(flag(where & column.isNull()))
    return F.count_distinct(F.when(where, column)) + F.coalesce(null_seen, F.lit(0))


def sum_na(column: Column) -> Column:
    """Sum that is NULL as soon as one input is NULL."""
    return F.when(F.count(column) == count_rows(), F.sum(column))


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition in which NULL matches NULL on every key."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def na_text(column: Column) -> Column:
    """Text form of a value, with NULL written as ``NA``."""
    return F.coalesce(column.cast("string"), F.lit("NA"))
