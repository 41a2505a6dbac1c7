"""A training corpus from raw documents: filter, deduplicate, redact, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All stages but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import exact_dedup, minhash_hamming, positive_unlabelled, weak_pii
from orderlens.llm.common import remove_dir, run_dir, saved, small
from orderlens.llm.queries import held_out, packing_of

#: Documents with a lower probability of being good are left out.
LEAST_QUALITY = 0.3
WORDS, PERCENT = 5, 80


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id is among the dropped ids; rows without an id stay."""
    ids = dropped.select(F.col(dropped.columns[0]).alias("dropped_id")).filter("dropped_id is not null").distinct()
    return docs.join(small(ids), F.col("doc_id") == F.col("dropped_id"), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being good is not too low."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out(F.col("doc_id")))
    scored = positive_unlabelled.quality_scores(
        docs, positives=labels.filter("quality = 1").select("doc_id"), labelled=labels.select("doc_id"), fit_on=~held_out(F.col("id"))
    )
    return without(docs, saved(scored.filter(F.col("score") < LEAST_QUALITY).select("id")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space.

    Of rows that repeat a doc_id with the same text one stays.
    """
    found = saved(exact_dedup.exact_duplicates(docs).filter("not kept").select("id"))
    kept = without(docs, found)
    repeated = kept.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1")
    repeated = saved(repeated.select(F.col("doc_id").alias("repeated_id")))
    if repeated.isEmpty():
        return kept
    again = F.col("doc_id") == F.col("repeated_id")
    once = kept.join(small(repeated), again, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(small(repeated), again, "left_anti").unionByName(once)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    found = saved(minhash_hamming.near_duplicates(docs, words=WORDS, percent=PERCENT).filter("not kept").select("id"))
    return without(docs, found)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind; n_chars counts the new text."""
    found = weak_pii.personal_data(docs, keep=docs.columns)
    old, hit = F.col("row_data.text"), F.size("cuts") > 0
    found = found.withColumn("redacted", F.when(hit, weak_pii.redacted(old, F.col("cuts"))).otherwise(old))
    new = {
        "text": F.col("redacted"),
        "n_chars": F.when(hit, F.char_length("redacted")).otherwise(F.col("row_data.n_chars")).cast(docs.schema["n_chars"].dataType),
    }
    return found.select(*[new.get(c, F.col("row_data")[c]).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each token piece of the documents lies in fixed-length sequences."""
    return packing_of(docs)


STAGES = [("quality", quality), ("exact dedup", exact), ("near dedup", near), ("personal data", private), ("packing", packing)]

#: The stages learn a model, estimate reliabilities and tokenize, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = run_dir(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    packed = saved(STAGES[-1][1](spark, docs, sf_dir))
    remove_dir(spark, folder)
    return packed
