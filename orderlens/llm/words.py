"""Word shingles and min-hash signatures of Arrow batches, with numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that are worked on at a time inside a batch.
SLICE_BYTES = 4 << 20
#: Rows of the product of shingles and hash functions held at a time.
HASH_ROWS = 1 << 13


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: a bijection whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers that depend on the seed alone."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) so that no slice of several rows holds more than ``limit`` bytes."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, texts.slice(start, stop - start)
        start = stop


def byte_table(lower: bool) -> np.ndarray:
    """What each byte becomes: ASCII white space a space, and A-Z lower-case if asked for."""
    table = np.arange(256, dtype=np.uint8)
    table[9:14] = ord(" ")
    if lower:
        table[ord("A") : ord("Z") + 1] += 32
    return table


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of the texts in UTF-8; null is empty."""
    filled = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = filled.buffers()
    offsets = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def split_at_spaces(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(row, word) of what spaces separate in the rows."""
    rows = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    lists = pc.split_pattern(rows, b" ")
    owner, flat = pc.list_parent_indices(lists), pc.list_flatten(lists)
    real = pc.greater(pc.binary_length(flat), 0)
    return np.asarray(owner.filter(real)), flat.filter(real)


def word_lists(texts: pa.Array, lower: bool) -> tuple[np.ndarray, pa.Array]:
    """(row, word) of all words of the texts in order: what ASCII white space separates.

    Bytes of longer UTF-8 sequences are never taken for white space.
    """
    offsets, data = bytes_of(texts)
    return split_at_spaces(offsets, byte_table(lower)[data])


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its runs of ``words`` words.

    A-Z count as a-z; words are what ASCII white space separates. A text of fewer
    words is one shingle as a whole; null, empty and blank texts have none.
    """
    factors = odd_numbers(words, 17)
    for _, part in slices(texts):
        owner, flat = word_lists(part, lower=True)
        coded = flat.dictionary_encode()
        names = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
        hashed = names[np.asarray(coded.indices)] if len(coded) else np.empty(0, np.uint64)
        bounds = np.searchsorted(owner, np.arange(len(part) + 1))
        n = max(0, len(hashed) - words + 1)
        runs = np.zeros(n, np.uint64)
        for k in range(words):
            runs += hashed[k : k + n] * factors[k]
        runs = mix(runs)
        for start, stop in zip(bounds[:-1], bounds[1:]):
            if stop - start >= words:
                yield np.unique(runs[start : stop - words + 1])
            elif stop > start:
                whole = (hashed[start:stop] * factors[: stop - start]).sum(dtype=np.uint64) + np.uint64(stop - start)
                yield mix(np.array([whole]))
            else:
                yield np.empty(0, np.uint64)


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """16 bits of the smallest hash under each of the functions."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), HASH_ROWS):
        least = np.minimum(least, (shingles[at : at + HASH_ROWS, None] * factors).min(axis=0))
    return (mix(least) >> np.uint64(48)).astype(np.uint16)
