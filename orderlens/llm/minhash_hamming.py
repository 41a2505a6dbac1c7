"""Near-duplicate documents: min-hash signatures in a multi-index Hamming join.

Every distinct shingle set gets a signature of ``HASHES`` symbols of 16 bits, the
min-hash values cut to b bits. Two sets whose signatures differ in at most
``2 * chunks - 1`` symbols agree, by pigeonhole, on one of the chunks up to one
symbol. Each chunk is therefore indexed once for every place an error can be in,
with that symbol left out, so all pairs within the distance meet under a common
key. Each symbol differs with a probability of one less the similarity; the number
of chunks is the smallest for which a pair just at the threshold exceeds the
distance at most once in ``1 / MISSED`` times (13 chunks at 0.85, 16 at 0.8).

Members of a key are only tied to its smallest member. The resulting candidate
groups are split into tiles of bounded size, and inside a tile a breadth-first
search confirms links on the full sets: a document that is reached already is
never compared again, so groups of copies cost one comparison per document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import connected_components, saved, small
from orderlens.llm.words import mix, odd_numbers, shingle_sets, signature, slices

HASHES = 64
#: Chance that a pair just at the threshold is beyond the signature distance.
MISSED = 4e-6
#: Shingles and documents that one tile of a candidate group holds on average.
TILE_SHINGLES = 2_000_000
TILE_DOCS = 4_096



def chunks_for(percent: int) -> int:
    """Chunks such that pairs at the threshold differ in two symbols of each at most with ``MISSED``."""
    p = 1 - percent / 100
    tail, k = 1.0, 0
    while tail > MISSED:
        tail -= comb(HASHES, k) * p**k * (1 - p) ** (HASHES - k)
        k += 1
    return max(1, min(HASHES, (k + 1) // 2))


SKETCH = "id long, n_shingles long, set_hash binary, signature binary"


def sketches(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, n_shingles, set_hash, signature) of every document that has an id."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = odd_numbers(HASHES, 91)
        for batch in batches:
            for first, part in slices(batch.column(1)):
                rows = [
                    (len(s), xxhash.xxh3_128_digest(s), signature(s, factors).tobytes()) if len(s) else (0, None, None)
                    for s in shingle_sets(part, words)
                ]
                columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.binary(), pa.binary()))]
                ids = batch.column(0).slice(first, len(part))
                yield pa.RecordBatch.from_arrays([ids, *columns], names=["id", "n_shingles", "set_hash", "signature"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id is not null")
    return rows.mapInArrow(sketch, SKETCH)


def chunk_keys(chunks: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, id): for each chunk and each place of an error, the chunk's other symbols."""
    bounds = np.linspace(0, HASHES, chunks + 1).astype(int)
    places = [(c, p) for c in range(chunks) for p in range(bounds[c], bounds[c + 1])]
    seeds = odd_numbers(len(places), 5)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            symbols = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, HASHES).astype(np.uint64)
            for k, (c, p) in enumerate(places):
                key = np.full(len(symbols), seeds[k])
                for at in range(bounds[c], bounds[c + 1]):
                    if at != p:
                        key = mix(key ^ symbols[:, at]) * seeds[k]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0)], names=["key", "id"])

    return keys


def linked(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set the position of the first set of its component.

    Two sets are linked when 100 * shared >= percent * union.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    factors = odd_numbers(HASHES, 91)
    signs = np.array([signature(s, factors) for s in sets]).reshape(n, HASHES)
    most = 2 * chunks_for(percent) - 1
    root = np.full(n, -1)
    free = np.arange(n)
    for first in range(n):
        if root[first] >= 0:
            continue
        root[first] = first
        free = free[root[free] < 0]
        queue = [first]
        while queue and len(free):
            x = queue.pop()
            near = (signs[free] != signs[x]).sum(axis=1) <= most
            near &= 100 * np.minimum(sizes[free], sizes[x]) >= percent * np.maximum(sizes[free], sizes[x])
            found = []
            for y in free[near]:
                few, many = (sets[x], sets[y]) if sizes[x] <= sizes[y] else (sets[y], sets[x])
                at = np.searchsorted(many, few)
                shared = int((many[np.minimum(at, len(many) - 1)] == few).sum())
                if 100 * shared >= percent * (sizes[x] + sizes[y] - shared):
                    root[y] = first
                    found.append(y)
            if found:
                queue += found
                free = free[root[free] < 0]
    return root.tolist()


def confirmed_links(members: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b) ties of every component of links inside each tile (group, i, j) of (id, text)."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, ids, sets = None, [], []

        def ties() -> pa.RecordBatch:
            # Set-copies are one entry, so links are searched between different sets only.
            root = linked(sets, percent)
            pairs = [(ids[r], ids[k]) for k, r in enumerate(root) if r != k]
            return pa.RecordBatch.from_arrays([pa.array([p[side] for p in pairs], pa.int64()) for side in (0, 1)], names=["a", "b"])

        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in range(4)))
            for (*now, doc), shingles in zip(keys, shingle_sets(batch.column(4), words)):
                if now != tile:
                    if len(ids) > 1:
                        yield ties()
                    tile, ids, sets = now, [], []
                ids.append(doc)
                sets.append(shingles)
        if len(ids) > 1:
            yield ties()

    sorted_tiles = members.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "id")
    return sorted_tiles.select("grp", "i", "j", "id", "text").mapInArrow(confirm, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, component, kept) for every row of docs.

    Documents are linked when ``100 * shared >= percent * union`` of their sets of
    ``words``-word shingles; component is the smallest id reachable over links and
    kept marks that document. A null, empty or blank text has no shingles, is linked
    with nothing and kept. Rows that repeat an id share one answer, taken over all of
    their texts; rows without an id come back with nulls, kept.
    """
    known = saved(sketches(docs, id_col, text_col, words))
    real = known.filter("set_hash is not null")
    copies = real.groupBy("set_hash").agg(F.min("id").alias("rep"), F.max("n_shingles").alias("size"))
    first = saved(
        real.join(copies, "set_hash").select("id", "rep", "n_shingles", F.when(F.col("id") == F.col("rep"), F.col("signature")).alias("signature"))
    )
    reps = first.filter("id = rep").dropDuplicates(["id", "signature"])
    keys = reps.select("id", "signature").mapInArrow(chunk_keys(chunks_for(percent)), "key long, id long")
    busy = keys.groupBy("key").agg(F.min("id").alias("center"), F.max("id").alias("last")).filter("center < last")
    ties = keys.join(busy.select("key", "center"), "key").filter("id > center").select("center", "id")
    groups = connected_components(ties, "center", "id").withColumnRenamed("component", "grp")
    sized = groups.join(reps.select("id", "n_shingles").groupBy("id").agg(F.max("n_shingles").alias("n_shingles")), "id")
    tiles = sized.groupBy("grp").agg(
        F.greatest(F.ceil(F.sum("n_shingles") / TILE_SHINGLES), F.ceil(F.count("*") / TILE_DOCS)).cast("int").alias("n")
    )
    placed = sized.join(tiles, "grp").select("id", "grp", "n", F.pmod(F.xxhash64("id"), F.col("n")).cast("int").alias("t"))
    placed = saved(
        placed.select("id", "grp", "t", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other")).select(
            "id", "grp", F.least("t", "other").alias("i"), F.greatest("t", "other").alias("j")
        )
    )
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = confirmed_links(texts.join(small(placed), "id"), words, percent)
    ids = first.filter("id > rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    several = known.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    if several:  # an id with several texts may tie components together: treat its texts as linked
        found = found.unionByName(ids)
    components = connected_components(found)
    rows = known.select("id", "n_shingles").join(first.select("id", "rep").dropDuplicates(["id"]), "id", "left")
    rows = rows.withColumn("rep", F.coalesce("rep", "id"))
    answer = rows.join(components.select(F.col("id").alias("rep"), "component"), "rep", "left").select(
        "id", "n_shingles", F.coalesce("component", "rep").alias("component")
    )
    answer = answer.withColumn("kept", F.col("id") == F.col("component"))
    lost = docs.filter(F.col(id_col).isNull()).select(
        F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component"), F.lit(True).alias("kept")
    )
    return answer.unionByName(lost)
