"""How text filters interact: which documents each filter takes in every order of the filters.

Filters that look at one text alone set bits of a mask per document. Whether a text is a copy
of one with a smaller id is found in radix tries: texts are dealt by ranges between prefixes
that are longer where texts share more, a task inserts its range's full texts into a
compressed trie, terminals hold the smallest id, and a walk over the terminals flags every
row above it. The masks of all documents are then summed, and everything about the orders
follows from these sums.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import filled, saved, small
from orderlens.llm.words import bytes_of, byte_table, slices, split_at_spaces

FILTERS = "ABCDE"
COPY = FILTERS.index("E")
LEAST_WORDS = 200
#: Percent of distinct words that a text has at least, and of capitals that it has at most.
LEAST_DISTINCT, MOST_CAPITALS = 50, 3
SIGNS = b"#$%&*|"

#: Bytes of text that one range holds on average, copies included.
RANGE_BYTES = 32 << 20
#: Bytes of a text that ranges are cut by at first, and how much longer prefixes grow where that is not enough.
HEAD_BYTES, LONGER = 16, 4
#: Bytes of text in the trie of a task that reads documents.
LOCAL_BYTES = 32 << 20

ROWS = "place int, part string, mask int, id long, n long, text binary"


class RadixTrie:
    """A compressed trie over byte strings; every node but the root has a label of one byte or more."""

    def __init__(self) -> None:
        self.labels: list[bytes] = [b""]
        self.children: list[dict[int, int] | None] = [None]
        self.least: list[int | None] = [None]
        self.held = 0

    def add(self, label: bytes) -> int:
        self.labels.append(label)
        self.children.append(None)
        self.least.append(None)
        return len(self.labels) - 1

    def insert(self, text: bytes) -> int:
        """The node that stands for the whole text, which is made where it is missing."""
        node = at = 0
        while at < len(text):
            below = self.children[node]
            child = below.get(text[at]) if below else None
            if child is None:
                leaf = self.add(text[at:])
                self.held += len(text) - at
                if below is None:
                    below = self.children[node] = {}
                below[text[at]] = leaf
                return leaf
            label = self.labels[child]
            if not text.startswith(label, at):
                # The edge is cut where text and label part.
                same, stop = 1, len(label)
                while stop - same > 1:
                    middle = (same + stop) // 2
                    if text.startswith(label[:middle], at):
                        same = middle
                    else:
                        stop = middle
                above = self.add(label[:same])
                self.labels[child] = label[same:]
                self.children[above] = {label[same]: child}
                below[text[at]] = above
                child, label = above, label[:same]
            node = child
            at += len(label)
        return node

    def lower(self, node: int, number: int) -> None:
        if self.least[node] is None or number < self.least[node]:
            self.least[node] = number


def masks(texts: pa.Array) -> np.ndarray:
    """For each text the bits of the filters that it fails by itself."""
    out = [np.empty(0, np.int32)]
    capital = np.zeros(256, bool)
    capital[ord("A") : ord("Z") + 1] = True
    sign = np.zeros(256, bool)
    sign[list(SIGNS)] = True
    for _, part in slices(texts):
        offsets, data = bytes_of(part)

        def per_text(hits: np.ndarray) -> np.ndarray:
            before = np.concatenate(([0], np.cumsum(hits)))
            return before[offsets[1:]] - before[offsets[:-1]]

        owner, flat = split_at_spaces(offsets, byte_table(lower=False)[data])
        words = np.bincount(owner, minlength=len(part))
        coded = flat.dictionary_encode()
        pairs = np.unique(owner.astype(np.int64) * (len(coded.dictionary) + 1) + np.asarray(coded.indices))
        distinct = np.bincount(pairs // (len(coded.dictionary) + 1), minlength=len(part))
        points = per_text((data & 0xC0) != 0x80)
        failed = [
            words < LEAST_WORDS,
            100 * distinct < LEAST_DISTINCT * words,
            100 * per_text(capital[data]) > MOST_CAPITALS * points,
            per_text(sign[data]) > 0,
        ]
        out.append(sum((f.astype(np.int32) << k for k, f in enumerate(failed)), np.zeros(len(part), np.int32)))
    return np.concatenate(out)


def range_starts(texts: DataFrame, range_bytes: int) -> list[bytes]:
    """The smallest texts of ranges, in byte order, from b"" on; texts is (text binary).

    A range holds at most ``range_bytes``, copies included, unless all its texts are equal.
    Cuts are prefixes of ``HEAD_BYTES``; those under which several texts are too many are
    looked at again with longer ones.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, starts, open_ = 0, [], []
        for batch in batches:
            for head, size, several in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if held + size > range_bytes:
                    starts.append(head)
                    open_.append(size > range_bytes and several)
                    held = 0
                held += size
        yield pa.RecordBatch.from_arrays([pa.array(starts, pa.binary()), pa.array(open_, pa.bool_())], names=["start", "open"])

    starts, length, rest = {b""}, HEAD_BYTES, texts.select("text", F.octet_length("text").cast("long").alias("bytes"))
    rest = rest.withColumn("hash", F.xxhash64("text"))
    while True:
        heads = rest.groupBy(F.substring("text", 1, length).alias("head")).agg(
            F.sum("bytes").alias("bytes"), (F.min("hash") != F.max("hash")).alias("several"), F.max("bytes").alias("longest")
        )
        heads = saved(heads)
        found = heads.select("head", "bytes", "several").repartitionByRange("head").sortWithinPartitions("head").mapInArrow(cut, "start binary, open boolean").collect()
        starts.update(bytes(r["start"]) for r in found)
        again = [bytes(r["start"]) for r in found if r["open"]]
        if not again:
            return sorted(starts)
        # At most one prefix for every range_bytes of all texts.
        prefixes = texts.sparkSession.createDataFrame([(p,) for p in again], "prefix binary")
        rest = rest.join(small(prefixes), F.substring("text", 1, length) == F.col("prefix"), "left_semi")
        length *= LONGER


def part_and_mask(starts: list[bytes], copies: bool = True):
    """A task's function from (part, id, text) to ``ROWS``.

    Copies that the task sees itself are flagged without sending their text on; place is
    the range of a text, or any place for rows that are decided. Of the texts it has read,
    a trie of ``LOCAL_BYTES`` remembers the smallest id; when it is full, texts that have
    come twice move to the next one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, often, turn = RadixTrie(), {}, 0
        for batch in batches:
            mask = masks(batch.column(2)).tolist()
            parts, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = [t or b"" for t in batch.column(2).to_pylist()]
            if trie.held > LOCAL_BYTES:
                trie = RadixTrie()
                if sum(map(len, often)) > LOCAL_BYTES // 2:
                    often = {}
                for text, least in often.items():
                    trie.lower(trie.insert(text), least)
            nodes = [trie.insert(t) for t in texts]
            for node, number, text in zip(nodes, ids, texts):
                if number is not None:
                    if trie.least[node] is not None:
                        often[text] = min(number, trie.least[node])
                    trie.lower(node, number)
            rows: dict[tuple, list] = {}
            for part, number, text, node, bits in zip(parts, ids, texts, nodes, mask):
                least = trie.least[node]
                open_ = number is not None and number == least
                if number is not None and number > least:
                    bits |= 1 << COPY
                row = rows.setdefault((part, bits, number, node if open_ else -1), [0, text if open_ else None])
                row[0] += 1
            places = []
            for _, text in rows.values():
                turn += 1
                places.append(turn % len(starts) if text is None else bisect_right(starts, text) - 1)
            keys = list(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(places, pa.int32()),
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([k[2] for k in keys], pa.int64()),
                    pa.array([r[0] for r in rows.values()], pa.int64()),
                    pa.array([r[1] for r in rows.values()], pa.binary()),
                ],
                names=["place", "part", "mask", "id", "n", "text"],
            )

    return run


def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, mask, id, n) from a range's rows of ``ROWS``; copies get their bit from the range's trie."""
    trie, held = RadixTrie(), []
    names = ["part", "mask", "id", "n"]
    for batch in batches:
        texts = batch.column("text")
        known = texts.is_null()
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(known) for c in names], names=names)
        rest = batch.filter(texts.is_valid())
        nodes = [trie.insert(t) for t in rest.column("text").to_pylist()]
        for node, number in zip(nodes, rest.column("id").to_pylist()):
            trie.lower(node, number)
        held.append((pa.RecordBatch.from_arrays([rest.column(c) for c in names], names=names), np.array(nodes, np.int64)))
    least = np.array([np.iinfo(np.int64).max if x is None else x for x in trie.least])
    for rows, nodes in held:
        copy = np.asarray(rows.column("id"), np.int64) > least[nodes] if len(nodes) else np.empty(0, bool)
        mask = np.asarray(rows.column("mask"), np.int32) | (copy.astype(np.int32) << COPY)
        yield rows.set_column(1, "mask", pa.array(mask))


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(part, mask, id, n): the filters that documents fail, bit k for filter k of ``FILTERS``.

    Rows with equal part, mask and id may stand as one with their number n. Null texts are
    empty, a null part is the empty string. A row without an id is no copy, and no row is a
    copy of it; of rows with the same text and the smallest id none is a copy.
    """
    rows = docs.select(
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(id_col).cast("long").alias("id"), filled(text_col).cast("binary").alias("text")
    )
    starts = range_starts(rows.select("text"), range_bytes)
    dealt = rows.mapInArrow(part_and_mask(starts), ROWS).repartitionById(len(starts), F.col("place"))
    return dealt.mapInArrow(flagged, "part string, mask int, id long, n long")


def orders_of(filters: str = FILTERS) -> Column:
    """An array with (filter_order, step, bit, before) for every step of every order."""
    steps = [
        F.struct(
            F.lit("".join(order)).alias("filter_order"),
            F.lit(k + 1).alias("step"),
            F.lit(1 << filters.index(name)).alias("bit"),
            F.lit(sum(1 << filters.index(f) for f in order[:k])).alias("before"),
        )
        for order in permutations(filters)
        for k, name in enumerate(order)
    ]
    return F.array(*steps)


def audited(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """What each filter does in each order: a row per part, filter_order and step.

    kept documents pass the filters up to this step, removed ones fail this filter first,
    redundant ones fail it after an earlier one, unique_fails fail it alone; good_lost and
    toxic_lost are the removed ones that labels (doc_id, quality, toxic) mark with 1.
    shapley is how many documents the filter removes, summed over all orders.

    Rows that repeat an id count one by one; of several labels of an id the highest counts,
    labels without an id count for nothing. An empty table gives no rows; columns other
    than the named ones are not read. See ``failures`` for nulls.
    """
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    failed = failures(docs, id_col, text_col, part_col, range_bytes).join(small(marks), "id", "left")
    sums = saved(
        failed.groupBy("part", "mask").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic")
        )
    )
    # From here on there are at most 32 rows a part.
    each = sums.select("*", F.explode(orders_of()).alias("at")).select("*", "at.*")
    hit, earlier = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    first = hit & ~earlier
    # Of the filters that a document fails, each comes first in the same number of orders.
    turns = F.lit(factorial(len(FILTERS))) / F.bit_count("mask")

    def total(condition: Column, value: Column | str = "n") -> Column:
        return F.sum(F.when(condition, F.col(value) if isinstance(value, str) else value).otherwise(0)).cast("long")

    return each.groupBy("part", "filter_order", "step").agg(
        total(~hit & ~earlier).alias("kept"),
        total(first).alias("removed"),
        total(hit & earlier).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(first, "good").alias("good_lost"),
        total(first, "toxic").alias("toxic_lost"),
        total(hit, F.col("n") * turns.cast("long")).alias("shapley"),
    )
