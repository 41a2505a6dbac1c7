"""Lookup tables: all text, read with a fixed schema, cut to one project."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

LOOKUPS = {
    "companies": ("city", "year", "group", "sku_code", "company"),
    "company_channels": ("city", "year", "channel_1", "company"),
    "regions": ("region", "codes"),
    "payways": ("group", "payway_code", "payway"),
    "listed_people": ("id_no",),
}

# Names of the two kinds of order in the lookups.
GROUP_NAMES = {"self": "个人", "com": "企业"}


def text_schema(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


#: Column that holds the line of a row that does not fit the lookup.
REJECTED = "rejected"


def _checked_lines(spark: SparkSession, name: str, path: str) -> DataFrame:
    """All rows of a CSV lookup; reading fails where a header differs from the declared columns."""
    schema = text_schema(*LOOKUPS[name], REJECTED)
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    # A parser that skips columns does not see how many fields a line has.
    reader = reader.option("columnPruning", False)
    return reader.option("columnNameOfCorruptRecord", REJECTED).csv(path)


def read_lookup(spark: SparkSession, name: str, path: str, fmt: str = "csv") -> DataFrame:
    """A lookup by name; every column is text, so codes keep their zeros.

    A CSV file must have the declared columns in its header. Its rows with too few or too many
    fields are left out here; :func:`rejected_rows` has them. Other formats must have the
    declared columns among theirs.
    """
    if fmt == "csv":
        lines = _checked_lines(spark, name, path)
        first = F.col(LOOKUPS[name][0])
        # The first column is part of the condition because Spark reads no CSV for the rejected column alone.
        sound = F.concat_ws("", first, REJECTED) == F.coalesce(first, F.lit(""))
        return lines.filter(sound).drop(REJECTED)
    df = spark.read.format(fmt).load(path)
    absent = [field for field in LOOKUPS[name] if field not in df.columns]
    if absent:
        raise ValueError(f"lookup {name} lacks {', '.join(absent)}")
    return df.select(*[F.col(field).cast("string") for field in LOOKUPS[name]])


def rejected_rows(spark: SparkSession, name: str, path: str) -> DataFrame:
    """(lookup, first field, line) of the rows of a CSV lookup that do not fit its columns."""
    lines = _checked_lines(spark, name, path)
    first = LOOKUPS[name][0]
    kept = lines.filter(F.concat_ws("", first, REJECTED) != F.coalesce(F.col(first), F.lit("")))
    return kept.select(F.lit(name).alias("lookup"), F.col(first).alias("first_field"), REJECTED)


def of_project(lookup: DataFrame, city: str, year: str, group: str | None = None) -> DataFrame:
    """Rows of one city and year, and of one kind of order."""
    rows = lookup.filter((F.col("city") == city) & (F.col("year") == year))
    if group is not None:
        rows = rows.filter(F.col("group") == GROUP_NAMES[group]).drop("group")
    return rows.drop("city", "year")


def require_rows(lookup: DataFrame, what: str) -> DataFrame:
    """Raise when a lookup the project cannot do without is empty."""
    if lookup.isEmpty():
        raise ValueError(f"no rows for {what}, please check the lookup")
    return lookup
