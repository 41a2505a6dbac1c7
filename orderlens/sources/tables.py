"""Snapshots of prepared tables and the report sinks."""

from __future__ import annotations

import tempfile
from collections.abc import Mapping, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a session without a cluster may come without one; it gets one here.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="orderlens-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def run_folder(spark: SparkSession, name: str) -> str:
    """A folder for one run alone, inside the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of :func:`run_folder`, wherever its store is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def snapshot(
    df: DataFrame, name: str, folder: str | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write ``df`` once and read it back, so several reports share the work."""
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)


def materialised(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder as a checkpoint.

    For tables one report reads several times: the work behind them is done
    once, and a lost executor has no long lineage to replay. Spark removes the
    files with the DataFrame where ``spark.cleaner.referenceTracking.cleanCheckpoints``
    is set, as :mod:`orderlens.session` does.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def read_snapshot(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    return spark.read.parquet(f"{folder or shared_folder(spark)}/{name}")


def write_reports(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> list[str]:
    """Write one table per report sheet below ``folder``."""
    paths = []
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{name}"
        writer = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.save(path)
        paths.append(path)
    return paths


#: Table with a row per report and run, and its state of each run.
PUBLISHED = "published"
RUN_KEYS = ("city", "run")
MARKS = "report string, rows long, complete boolean, city string, run string"


def _of_run(df: DataFrame, city: str, run: str, path: str, *more: str) -> None:
    """Replace the partitions of one run in the table at ``path``; those of other runs stay."""
    named = df.withColumns({"city": F.lit(city), "run": F.lit(run)})
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*RUN_KEYS, *more).parquet(path)


def publish(
    reports: Mapping[str, DataFrame], folder: str, city: str, run: str, per_company: Sequence[str] = ()
) -> list[str]:
    """Write the reports of one run, each into its table below ``folder``.

    Tables are partitioned by city and run, those named in ``per_company`` by company as well. A
    run that is written again replaces its own partitions only. Table ``published`` marks the
    run as incomplete before and, with the rows of every report, as complete after all
    are written; :func:`read_published` goes by it. Reports must have no columns city and run.
    """
    folder, paths, marks = folder.rstrip("/"), [], []
    spark = next(iter(reports.values())).sparkSession if reports else None
    if spark is None:
        return paths

    def mark(rows: list[tuple]) -> None:
        df = spark.createDataFrame([(*row, city, run) for row in rows], MARKS)
        _of_run(df.drop(*RUN_KEYS).coalesce(1), city, run, f"{folder}/{PUBLISHED}")

    mark([(None, None, False)])
    for name, df in reports.items():
        taken = [key for key in RUN_KEYS if key in df.columns]
        if taken:
            raise ValueError(f"report {name} has a column {taken[0]} of its own")
        counted = Observation()
        observed = df.observe(counted, F.count(F.lit(1)).alias("rows"))
        _of_run(observed, city, run, f"{folder}/{name}", *(["company"] if name in per_company else []))
        marks.append((name, counted.get.get("rows", 0), True))
        paths.append(f"{folder}/{name}")
    mark(marks)
    return paths


def read_published(spark: SparkSession, folder: str, name: str, latest: bool = True) -> DataFrame:
    """A report as its complete runs left it, of each city's latest run or of all of them.

    What a run wrote that did not end is not seen, nor what is left of an earlier
    writing of a run whose report is empty now.
    """
    folder = folder.rstrip("/")
    marks = spark.read.schema(MARKS).parquet(f"{folder}/{PUBLISHED}").filter("complete")
    if latest:
        marks = marks.join(marks.groupBy("city").agg(F.max("run").alias("run")), list(RUN_KEYS), "left_semi")
    runs = marks.filter((F.col("report") == name) & (F.col("rows") > 0)).select(*RUN_KEYS).distinct()
    path = f"{folder}/{name}"
    found = spark.read.option("mergeSchema", True).parquet(path).schema
    keys = {*RUN_KEYS, "company"} if "company" in found.names else set(RUN_KEYS)
    # Keys are text: a run named 007 is not run 7.
    schema = StructType([StructField(f.name, StringType()) if f.name in keys else f for f in found])
    return spark.read.schema(schema).parquet(path).join(runs, list(RUN_KEYS), "left_semi")


def newest(spark: SparkSession, path: str, column: str = "date_created") -> DataFrame:
    """Newest value of a column of a Parquet table, as ``newest``, from the statistics in the files' footers.

    Dates and numbers are found there, and times without a zone in microseconds, as Spark writes
    them; other columns are read. All files must have the same columns in the same order, as those of
    one table written by Spark have. The session that the result belongs to has the settings that let
    Spark push the maximum into the scan.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    session.conf.set("spark.sql.session.timeZone", "UTC")
    schema = session.read.parquet(path).schema
    if not isinstance(schema[column].dataType, TimestampNTZType):
        return session.read.schema(schema).parquet(path).agg(F.max(column).alias("newest"))
    # Spark pushes no maximum of times, but that of the numbers that stand for them.
    numbers = StructType([StructField(f.name, LongType()) if f.name == column else f for f in schema])
    found = session.read.schema(numbers).parquet(path).agg(F.max(column).alias("newest"))
    return found.select(F.timestamp_micros("newest").cast("timestamp_ntz").alias("newest"))


def write_per_company(df: DataFrame, path: str, company: str = "company") -> None:
    """One folder of files per company, to hand each its own list."""
    df.write.mode("overwrite").partitionBy(company).parquet(path)
