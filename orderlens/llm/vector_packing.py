"""Sharding as vector bin packing: bytes, tokens and rows are balanced together.

Equal texts are one group. A group is placed on the shard where the dot product of
its size vector with the shard's residual capacity is highest, largest groups first.
Groups that hold a noticeable part of a shard are few by their definition and are
placed first, on the shards as a whole. All others are dealt by hash into cells of
bounded size, each of which fills its own part of every shard's remaining
capacity, so cells are independent tasks and their small errors do not add up on one shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.llm.common import filled, saved, small

#: A group is large if it holds more than this part of a shard's bytes.
LARGE_SHARE = 1 / 256
#: Groups that one cell places on average.
CELL_GROUPS = 20_000
#: Rows that one task numbers at a time, on average.
NUMBERED_ROWS = 100_000
#: Exchanges a shard on average after placing, the least gain of one, and what shifts of the other sizes cost in it.
SWAPS = 24
LEAST_GAIN = 1e-7
OTHERS_WEIGHT = 1.0
#: Bytes counted for a document beside its text.
ROW_BYTES = 16


def place(sizes: np.ndarray, room: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Shard of each size vector; ``room`` (shards x dimensions) is what is left and changes.

    Room and sizes are compared after dividing by ``scale``; vectors are taken by the falling sum
    of their parts. A vector goes to the shard with the highest dot product of both among
    those that it fits into as a whole; if there is none, where it exceeds the room of no dimension
    by much. Then the first dimension is made even.
    """
    out = np.zeros(len(sizes), np.int64)
    unit, left = sizes / scale, room / scale
    order = np.lexsort((-sizes[:, 1], -sizes[:, 0], -unit.sum(axis=1)))
    for k in order:
        after = left - unit[k]
        fits = (after >= 0).all(axis=1)
        if fits.any():
            best = int(np.argmax(np.where(fits, left @ unit[k], -np.inf)))
        else:
            best = int(np.argmax(after.min(axis=1)))
        out[k] = best
        left[best] -= unit[k]
    even_out(out, unit, left)
    room[:] = left * scale
    return out


def even_out(out: np.ndarray, unit: np.ndarray, left: np.ndarray) -> None:
    """Move or exchange vectors until the shards' rooms in the first dimension are as even as that makes them.

    Each step takes the shards with most and least room and, among the exchanges that bring the two
    closer, one near the middle that shifts little of the other dimensions.
    """
    for _ in range(SWAPS * len(left)):
        full, free = int(np.argmin(left[:, 0])), int(np.argmax(left[:, 0]))
        gap = (left[free, 0] - left[full, 0]) / 2
        mine, theirs = np.flatnonzero(out == full), np.flatnonzero(out == free)
        theirs = theirs[np.argsort(unit[theirs, 0], kind="stable")]
        # The first partner is none: the vector moves alone.
        other = np.vstack((np.zeros((1, unit.shape[1])), unit[theirs]))
        at = np.searchsorted(other[:, 0], unit[mine, 0] - gap)
        i = np.concatenate((mine, mine))
        j = np.concatenate((np.maximum(at - 1, 0), np.minimum(at, len(theirs))))
        shift = unit[i] - other[j]
        good = np.flatnonzero((shift[:, 0] > LEAST_GAIN) & (shift[:, 0] < 2 * gap - LEAST_GAIN))
        if not len(good):
            return
        cost = np.abs(shift[good, 0] - gap) + OTHERS_WEIGHT * np.abs(shift[good, 1:]).sum(axis=1)
        best = good[int(np.argmin(cost))]
        out[i[best]] = free
        if j[best]:
            out[theirs[j[best] - 1]] = full
        left[full] += shift[best]
        left[free] -= shift[best]


def spaced_parts(text: Column) -> Column:
    """How many parts single spaces cut the text into: a cheap stand-in for its tokens."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit(""))) + 1


def sharded(
    docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row of docs; sizes of shards are near equal.

    size is the UTF-8 bytes of the text, 0 for null, and ``ROW_BYTES``; ``tokens`` counts the tokens
    of a row from its columns (default: ``spaced_parts``). Rows with equal texts, null and empty
    alike, are on one shard, unless they hold more than a shard's part of all
    bytes; then they are cut into parts that fit, by a hash of the row. Slots are gapless from 0
    in a shard, by part and id. Repeated ids are rows of their own, null ids come first.
    """
    text = filled(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("text_key"),
        (tokens if tokens is not None else spaced_parts(text)).cast("long").alias("tokens"),
    )
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()))
    groups = saved(rows.groupBy("text_key").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("n")))
    total = groups.agg(F.sum("bytes"), F.sum("tokens"), F.sum("n"), F.count("*")).first()
    if not total[0]:
        return rows.select("id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    capacity = np.array([max(float(x), 1.0) for x in total[:3]]) / shards
    parts = groups.select("text_key", F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(float(capacity[0])))).cast("int").alias("parts"))
    split = saved(parts.filter("parts > 1"))
    cut = rows.join(small(split), "text_key", "left")
    cut = cut.withColumn("part", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("row"), F.col("parts"))).otherwise(0).cast("int"))
    whole = groups.join(small(split.select("text_key")), "text_key", "left_anti").withColumn("part", F.lit(0))
    pieces = cut.filter("parts > 1").groupBy("text_key", "part").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    groups = saved(whole.unionByName(pieces))
    # Fewer than shards / LARGE_SHARE groups can each hold that part of a shard.
    limit = float(capacity[0] * LARGE_SHARE)
    large = groups.filter(F.col("bytes") > limit).orderBy("text_key", "part").collect()
    room = np.tile(capacity, (shards, 1))
    vectors = np.array([[r["bytes"], r["tokens"], r["n"]] for r in large], float).reshape(-1, 3)
    chosen = place(vectors, room, capacity)
    spark = docs.sparkSession
    fixed = spark.createDataFrame(
        [(bytes(r["text_key"]), r["part"], int(s)) for r, s in zip(large, chosen)], "text_key binary, part int, shard int"
    )
    rest = np.maximum(room, 0)
    cells = max(1, -(-(total[3] - len(large)) // CELL_GROUPS))

    def fill(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("text_key", "ascending"), ("part", "ascending")])
        sizes = np.column_stack([np.asarray(table[c], float) for c in ("bytes", "tokens", "n")])
        own = sizes.sum(axis=0)
        share = rest * (own / np.maximum(rest.sum(axis=0), 1e-9))
        # Each cell meets the shards in an order of its own, so no shard wins all ties.
        turn = np.random.default_rng(key[0].as_py()).permutation(shards)
        shard = turn[place(sizes, share[turn], np.maximum(own / shards, 1e-9))]
        return pa.table({"text_key": table["text_key"], "part": table["part"], "shard": pa.array(shard, pa.int32())})

    dealt = groups.filter(F.col("bytes") <= limit).withColumn("cell", F.pmod(F.xxhash64("text_key", "part"), F.lit(cells)))
    placed = dealt.groupBy("cell").applyInArrow(fill, "text_key binary, part int, shard int")
    answer = saved(cut.join(saved(placed.unionByName(fixed)), ["text_key", "part"]).select("id", "size", "text_crc32", "shard", "row"))
    buckets = max(1, -(-total[2] // (NUMBERED_ROWS * shards)))
    answer = answer.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    counts = answer.groupBy("shard", "bucket").agg(F.count("*").alias("held"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("shard", "bucket", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    inside = W.partitionBy("shard", "bucket").orderBy("id", "row")
    numbered = answer.withColumn("k", F.row_number().over(inside)).join(small(counts), ["shard", "bucket"])
    return numbered.select("id", "size", "text_crc32", "shard", (F.col("before") + F.col("k") - 1).cast("long").alias("slot"))
