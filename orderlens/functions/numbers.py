"""Ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, digits: int) -> Column:
    """Round to the nearest ``digits``-decimal double, exact ties to the even digit.

    The candidates below and above are compared with the value in double
    arithmetic: 0.15 goes to 0.1 (its double lies below the tie), 0.125 to 0.12.
    """
    scale = F.lit(float(10**digits))
    size = F.abs(value.cast("double"))
    steps = F.floor(size * scale).cast("double")
    below = steps / scale
    above = F.ceil(size * scale).cast("double") / scale
    to_above = above - size
    to_below = size - below
    go_up = (to_above < to_below) | ((to_above == to_below) & (steps % 2 == 1))
    rounded = F.when(go_up, above).otherwise(below)
    return F.when((value < 0) & (rounded != 0), -rounded).otherwise(rounded)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; NULL when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def share(numerator: Column, denominator: Column, digits: int) -> Column:
    return round_even(ratio(numerator, denominator), digits)


def percent_text(value: Column) -> Column:
    """Display form with one decimal, e.g. ``12.3%``."""
    return F.format_string("%.1f%%", value * 100)
