"""Helpers that several operators share: shared folder, checked broadcast, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

#: The characters that separate words, as a regex class and as a list for ``translate``.
SPACES = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: Rows of a batch that goes to Python while a table is saved.
ARROW_ROWS = 2_000
#: Bytes of such a batch, but for one row of more.
ARROW_BYTES = 8 << 20
#: Rows of narrow columns (an id, a hash, a few numbers) that are broadcast at most.
BROADCAST_ROWS = 400_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    It is set here only where it is unset and the master is local, as in tests;
    a cluster without it is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="checkpoint-")
        spark.conf.set("spark.checkpoint.dir", named)
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(named)
    return named.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, inside the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, folder: str) -> None:
    """Delete a folder of ``run_dir`` in whatever store it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def with_short_batches(spark: SparkSession, action: Callable[[], T]) -> T:
    """What the action returns; Python tasks meanwhile get at most ``ARROW_ROWS`` rows and about
    ``ARROW_BYTES`` at a time, so that long texts do not add up in a batch."""
    keys = {"spark.sql.execution.arrow.maxRecordsPerBatch": ARROW_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": ARROW_BYTES}
    before = {key: spark.conf.get(key) for key in keys}
    for key, most in keys.items():
        now = int(before[key].removesuffix("b"))
        spark.conf.set(key, str(min(now, most) if now > 0 else most))
    try:
        return action()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def saved(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the shared folder."""
    shared_dir(df.sparkSession)
    return with_short_batches(df.sparkSession, df.checkpoint)


def stored(df: DataFrame, folder: str) -> DataFrame:
    """The same rows, written as Parquet and read again, so that later steps read only the columns they need."""
    with_short_batches(df.sparkSession, lambda: df.write.parquet(folder))
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if a count finds at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def filled(text: str) -> Column:
    """The text column, with null as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))


def without_spaces(text: Column) -> Column:
    """The text after deleting every character of ``SPACES``."""
    return F.translate(text, SPACE_CHARS, "")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every node that has an edge; component is its smallest id.

    Alternates large-star and small-star rounds: every node's neighbours are tied
    to the smallest of them. Minima come from aggregations, so a node with many
    neighbours is never gathered, and joins on such a node are split by adaptive
    execution. Nulls and loops are left out; no edges give no rows.
    """

    def mark(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = saved(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct())
    seen, last = mark(now), None
    while seen != last and seen[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = now.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(lowest, "u")
        now = saved(
            tied.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest.select("u", F.col("m").alias("v"))).distinct()
        )
        seen, last = mark(now), seen
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
