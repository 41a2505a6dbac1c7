"""Joins of the order fact with lookup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup up to this many rows is sent to every task; its rows are a few short
# texts, so this stays within some tens of megabytes.
SMALL_LOOKUP_ROWS = 200_000


def is_small(lookup: DataFrame, max_rows: int = SMALL_LOOKUP_ROWS) -> bool:
    """Whether the lookup has at most ``max_rows`` rows; reads no more than that."""
    return lookup.limit(max_rows + 1).count() <= max_rows


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: str | list[str] | Column,
    how: str = "left",
    max_rows: int = SMALL_LOOKUP_ROWS,
) -> DataFrame:
    """Join a lookup to the fact without moving the fact, if the lookup is small.

    The rows are counted first. Beyond the bound the join is left to Spark:
    both sides are shuffled, and adaptive execution splits the hot keys
    (orders without a channel, say) by their real size.
    """
    return fact.join(F.broadcast(lookup) if is_small(lookup, max_rows) else lookup, on, how)
