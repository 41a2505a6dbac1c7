"""Exact duplicates: one row of each group of texts that are equal but for white space."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import filled, saved, small, without_spaces


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row of docs.

    Texts are equal when identical after all ASCII white space is deleted; null
    counts as empty. Of equal texts the row with the most code points, then the
    smallest id, stays. Rows are grouped by a 128-bit hash of the normalised text;
    under hashes that occur more than once the normalised bytes themselves are
    grouped, so texts that share a hash and differ stay apart. Only those texts
    are shuffled, after equal ones in one task have been merged.

    Rows that repeat an id are counted one by one and share their text's answer. A
    row without an id counts in its group, loses to every row with an id, and has
    kept false unless its group has no id at all.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), filled(text_col).alias("text"))
    texts = texts.withColumn("norm", without_spaces(F.col("text")))
    texts = texts.select("id", F.unhex(F.md5("norm")).alias("hash"), F.char_length("text").alias("points"), "norm")
    rows = saved(texts.select("id", "hash", "points", F.sha2("norm", 256).alias("text_sha256")))
    repeated = rows.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash")
    copies = texts.join(small(repeated), "hash", "left_semi")
    # One row per normalised text: its bytes are part of the grouping key.
    by_length = copies.groupBy("hash", "norm", "points").agg(
        F.count("*").alias("n"), F.min("id").alias("id"), F.sha2("norm", 256).alias("text_sha256")
    )
    classes = saved(
        by_length.withColumn("rank", F.when(F.col("id").isNotNull(), F.struct("points", (-F.col("id")).alias("minus_id"))))
        .groupBy("hash", "norm")
        .agg(F.sum("n").alias("group_size"), F.max("rank").alias("best"), F.min("text_sha256").alias("text_sha256"))
        .select("hash", "text_sha256", "group_size", (-F.col("best.minus_id")).alias("keep_id"))
    )
    # A second class under a hash is told apart by the longer digest of its bytes.
    answer = rows.join(classes, ["hash", "text_sha256"], "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("id")).otherwise(F.col("keep_id"))
    return answer.select(
        "id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )
