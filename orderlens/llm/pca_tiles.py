"""Near-duplicate vectors: an exact cosine self-join in tiles, leading principal parts first.

Unit vectors are rotated to their principal axes, so that the first few parts hold
most of a product. The product over those parts, plus the product of the norms of
the remaining ones, bounds the cosine from above; pairs whose bound is below the
threshold are finished. The others go on part by part, each time with the shorter
remainder's bound, and what is left is decided in full. Vectors are cut into tiles
along the first axis; tiles whose intervals lie farther apart than close vectors
can be are never compared.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import connected_components, saved

#: Different vectors in a tile, on average.
TILE_VECTORS = 8_192
#: Rows of a tile that are compared at a time.
BLOCK = 1_024
#: Leading parts after each step; all are used in the end.
STEPS = (16, 32)
#: Pairs that are worked on at a time beyond the first step.
PAIRS = 1 << 18
#: Cosines this near to the threshold are computed again from the vectors as given.
NEAR = 1e-9


def principal_axes(units: DataFrame, size: int) -> np.ndarray:
    """The axes of all unit vectors, by falling variance; only size * size sums reach the driver."""

    def products(batches):
        total = np.zeros((size, size))
        for batch in batches:
            x = unit_rows(batch.column(0), size)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.ravel())], names=["at", "x"])

    sums = units.select("vector").mapInArrow(products, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()
    gram = np.zeros(size * size)
    for row in sums:
        gram[row["at"]] = row["x"]
    gram = gram.reshape(size, size)
    return np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1].copy()


def unit_rows(vectors: pa.Array, size: int) -> np.ndarray:
    """Rows of length one, in double precision."""
    x = np.asarray(pc.list_flatten(vectors), np.float64).reshape(-1, size)
    # Powers of two change no digits; squares of very large or small parts stay in range.
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after joining the groups at both ends of every pair."""
    apart = label[i] != label[j]
    if not apart.any():
        return label
    parent: dict[int, int] = {}

    def root(k: int) -> int:
        while parent.setdefault(k, k) != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for x, y in np.unique(np.column_stack((label[i[apart]], label[j[apart]])), axis=0).tolist():
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    names = np.arange(len(label))
    for k in list(parent):
        names[k] = root(k)
    return names[label]


def linked_pairs(left: np.ndarray, right: np.ndarray, left_units: np.ndarray, right_units: np.ndarray, threshold: float):
    """Blocks of (row of left, row of right) with a cosine of at least the threshold.

    left and right are rotated unit vectors; the others are the vectors before rotation.
    """
    size = left.shape[1]
    steps = [s for s in STEPS if s < size]
    lead = steps[0] if steps else size

    def tails(x: np.ndarray) -> list[np.ndarray]:
        return [np.sqrt((x[:, s:] ** 2).sum(axis=1)) for s in steps]

    left_tail, right_tail = tails(left), tails(right)
    slack = threshold - NEAR
    # The norms of the remainders as one more part: the product is the bound itself.
    head = np.column_stack((right[:, :lead], right_tail[0])) if steps else right
    for at in range(0, len(left), BLOCK):
        part = left[at : at + BLOCK]
        first = np.column_stack((part[:, :lead], left_tail[0][at : at + BLOCK])) if steps else part
        alive = np.flatnonzero((first @ head.T >= slack).ravel())
        for some in range(0, len(alive), PAIRS):
            i, j = np.divmod(alive[some : some + PAIRS], len(right))
            i = i + at
            sums = np.einsum("ij,ij->i", left[i, :lead], right[j, :lead])
            done = lead
            for k, step in enumerate([*steps[1:], size], start=1):
                if step > done:
                    sums += np.einsum("ij,ij->i", left[i, done:step], right[j, done:step])
                bound = sums + left_tail[k][i] * right_tail[k][j] if step < size else sums
                keep = bound >= slack
                i, j, sums, done = i[keep], j[keep], sums[keep], step
            close = np.abs(sums - threshold) <= NEAR
            if close.any():
                sums[close] = np.einsum("ij,ij->i", left_units[i[close]], right_units[j[close]])
            sure = sums >= threshold
            if sure.any():
                yield i[sure], j[sure]


def links_of(distinct: DataFrame, size: int, threshold: float) -> DataFrame:
    """(rep, links, root) from the comparison of different vectors of one length, a row per tile pair and vector.

    distinct has vector, rep and n, the number of rows with that vector; links counts these rows.
    root is a vector that rep is linked with.
    """
    kind = distinct.schema["vector"].dataType.simpleString()
    axes = principal_axes(distinct, size)

    def along(batches):
        for batch in batches:
            first = unit_rows(batch.column(0), size) @ axes[:, 0]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(first), batch.column(0)], names=["rep", "n", "first", "vector"])

    placed = saved(distinct.select("vector", "rep", "n").mapInArrow(along, f"rep long, n long, first double, vector {kind}"))
    tiles = max(1, -(-placed.count() // TILE_VECTORS))
    cuts = sorted(set(placed.approxQuantile("first", [k / tiles for k in range(1, tiles)], 0.1 / tiles))) if tiles > 1 else []
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9

    def tiled(batches):
        for batch in batches:
            first = np.asarray(batch.column(2))
            bounds = [np.searchsorted(cuts, first + d, side="right").astype(np.int32) for d in (0.0, -reach, reach)]
            columns = [batch.column(0), batch.column(1), batch.column(3), *map(pa.array, bounds)]
            yield pa.RecordBatch.from_arrays(columns, names=["rep", "n", "vector", "tile", "low", "high"])

    spread = placed.mapInArrow(tiled, f"rep long, n long, vector {kind}, tile int, low int, high int")
    spread = spread.withColumn("other", F.explode(F.sequence("low", "high"))).drop("low", "high")
    spread = spread.withColumns({"a": F.least("tile", "other"), "b": F.greatest("tile", "other")})

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        a, b = (k.as_py() for k in key)
        tile, reps, counts = (np.asarray(table[c]) for c in ("tile", "rep", "n"))
        units = unit_rows(table["vector"].combine_chunks(), size)
        turned = units @ axes
        one, two = np.flatnonzero(tile == a), np.flatnonzero(tile == b)
        links, label = np.zeros(len(reps)), np.arange(len(reps))
        for i, j in linked_pairs(turned[one], turned[two], units[one], units[two], threshold):
            i, j = one[i], two[j]
            if a == b:
                i, j = i[i != j], j[i != j]
            links += np.bincount(i, counts[j], len(reps))
            if a != b:
                links += np.bincount(j, counts[i], len(reps))
            label = joined(label, i, j)
        some = np.flatnonzero(links)
        columns = {"rep": reps[some], "links": links[some].astype(np.int64), "root": reps[label[some]]}
        return pa.table({k: pa.array(v, pa.int64()) for k, v in columns.items()})

    return saved(spread.groupBy("a", "b").applyInArrow(compare, "rep long, links long, root long"))


def near_vectors(
    vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(id, n_links, component, kept) for every row of vectors.

    Rows are linked when the cosine of their vectors is at least the threshold, in double
    precision. Null and zero vectors and those with null or non-finite parts link with nothing,
    vectors of different lengths not with each other; each length is compared on axes
    of its own, one after another. component is the smallest id reachable
    over links, kept marks that row. Identical vectors are compared once and counted
    with their number. Rows that repeat an id are rows of their own for n_links and share a
    component; rows without an id come back with no links, kept.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    if rows.schema["vector"].dataType.simpleString() != "array<float>":
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    sound = F.coalesce(F.col("id").isNotNull() & finite & F.exists("vector", lambda v: v != 0), F.lit(False))
    rows = saved(rows.withColumn("sound", sound))
    nothing = F.lit(0).cast("long")
    sound_rows = rows.filter("sound")
    distinct = saved(sound_rows.groupBy("vector").agg(F.min("id").alias("rep"), F.count("*").alias("n")))
    sizes = [r["size"] for r in distinct.select(F.size("vector").alias("size")).distinct().orderBy("size").collect()]
    if not sizes:
        return rows.select("id", nothing.alias("n_links"), F.col("id").alias("component"), F.lit(True).alias("kept"))
    found = reduce(DataFrame.unionByName, [links_of(distinct.filter(F.size("vector") == size), size, threshold) for size in sizes])
    components = connected_components(found, "rep", "root")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = distinct.select("vector", "rep", "n").join(links, "rep", "left").join(components.withColumnRenamed("id", "rep"), "rep", "left")
    known = known.select(
        "vector", (F.coalesce("links", nothing) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")
    )
    sound_rows = sound_rows.select("id", "vector").join(known, "vector").select("id", "n_links", "component")
    others = rows.filter(~F.col("sound"))
    answer = sound_rows.unionByName(others.select("id", nothing.alias("n_links"), F.col("id").alias("component")))
    return answer.withColumn("kept", F.col("id").eqNullSafe(F.col("component")))
