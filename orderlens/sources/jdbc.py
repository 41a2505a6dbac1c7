"""Partitioned reads from the order database."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession


def time_slices(
    start: datetime, end: datetime, slices: int, column: str = "date_created", inclusive_end: bool = False
) -> list[str]:
    """Predicates that cut ``[start, end)`` into equal parts, one per read task."""
    if slices < 1 or end <= start:
        raise ValueError("need at least one slice and start before end")
    step = (end - start) / slices
    bounds = [start + step * i for i in range(slices)] + [end]
    bounds = [bound - timedelta(microseconds=bound.microsecond) for bound in bounds]
    predicates = [
        f"{column} >= '{low:%Y-%m-%d %H:%M:%S}' AND {column} < '{high:%Y-%m-%d %H:%M:%S}'"
        for low, high in zip(bounds, bounds[1:])
    ]
    if inclusive_end:
        head, _, tail = predicates[-1].rpartition("<")
        predicates[-1] = f"{head}<={tail}"
    return predicates


def read_period(
    spark: SparkSession,
    url: str,
    table: str,
    start: datetime,
    end: datetime,
    slices: int = 64,
    inclusive_end: bool = False,
    **options: str,
) -> DataFrame:
    """Rows of a table created in the period, read in parallel by time slice.

    ``options`` are the reader's own (driver, credentials, fetch size). The
    filters and columns of later steps are pushed into each slice's query.
    """
    return spark.read.jdbc(
        url,
        table,
        predicates=time_slices(start, end, slices, inclusive_end=inclusive_end),
        properties=options,
    )


def read_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A whole table without a time range, such as channels or tasks."""
    return spark.read.jdbc(url, table, properties=options)
