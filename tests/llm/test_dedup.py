"""Exact and near duplicates against brute force."""

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from orderlens.llm import exact_dedup, minhash_hamming, words
from orderlens.llm.common import connected_components
from tests.llm.helpers import documents, found, prose, sha, texts


def exact_by_hand(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    return {i: (min(g)[1], len(g), i == min(g)[1], sha(k)) for k, g in groups.items() for _, i in g}


def test_exact_duplicates(spark):
    rows = list(enumerate(texts(), start=5)) + [(100 + k, "same  text" if k % 2 else "same text") for k in range(30)]
    got = found(exact_dedup.exact_duplicates(documents(spark, rows)))
    assert {i: (r.keep_id, r.group_size, r.kept, r.text_sha256) for i, r in got.items()} == exact_by_hand(rows)


def test_exact_duplicates_empty_null_and_repeated_ids(spark):
    assert exact_dedup.exact_duplicates(documents(spark, [])).count() == 0
    got = exact_dedup.exact_duplicates(documents(spark, [(None, "a"), (3, "a"), (3, "a"), (None, "b"), (None, "b")])).collect()
    assert sorted((str(r.id), str(r.keep_id), r.group_size, r.kept) for r in got) == [
        ("3", "3", 3, True), ("3", "3", 3, True), ("None", "3", 3, False), ("None", "None", 2, True), ("None", "None", 2, True),
    ]


def shingles(text, n=5):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def near_by_hand(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i), top(i) == i) for i in sets}


def variants(n):
    """Copies of a text with more and more words changed, so that links form chains."""
    out = []
    for k in range(n):
        w = prose(9, 200).split()
        for at in range(k):
            w[(at * 37) % 200] = f"new{at}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, percent):
    rows = list(enumerate([*texts(), *variants(12), *[prose(50 + k, 80) for k in range(20)]], start=5))
    got = found(minhash_hamming.near_duplicates(documents(spark, rows), percent=percent))
    assert {i: (r.n_shingles, r.component, r.kept) for i, r in got.items()} == near_by_hand(rows, percent)


def test_near_duplicates_in_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(minhash_hamming, "TILE_DOCS", 3)
    rows = list(enumerate(variants(30), start=1))
    got = found(minhash_hamming.near_duplicates(documents(spark, rows), percent=85))
    assert {i: (r.n_shingles, r.component, r.kept) for i, r in got.items()} == near_by_hand(rows, 85)


def test_near_duplicates_empty_null_and_repeated_ids(spark):
    assert minhash_hamming.near_duplicates(documents(spark, [])).count() == 0
    rows = [(None, "a b"), (4, "a b"), (4, "c d"), (7, "c d"), (9, None)]
    got = minhash_hamming.near_duplicates(documents(spark, rows)).collect()
    assert sorted((str(r.id), str(r.component), r.kept) for r in got) == [
        ("4", "4", True), ("4", "4", True), ("7", "4", False), ("9", "9", True), ("None", "None", True),
    ]


def test_pigeonhole_keys_cover_the_distance():
    """Any two signatures within the distance share a key, wherever the differences are."""
    rng = np.random.default_rng(3)
    chunks = minhash_hamming.chunks_for(85)
    keys = minhash_hamming.chunk_keys(chunks)
    for _ in range(50):
        one = rng.integers(0, 1 << 16, minhash_hamming.HASHES, dtype=np.uint16)
        two = one.copy()
        two[rng.choice(minhash_hamming.HASHES, 2 * chunks - 1, replace=False)] ^= 1
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([one.tobytes(), two.tobytes()])], names=["id", "s"])
        assert any(a == b for a, b in (b.column(0).to_pylist() for b in keys([batch])))


def test_words_are_split_at_ascii_space_only():
    owner, flat = words.word_lists(pa.array(["…\x85a\xa0b c", None, " \t"]), lower=True)
    assert [w.decode() for w in flat.to_pylist()] == ["…\x85a\xa0b", "c"] and owner.tolist() == [0, 0]


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 50), (60, 100), (7, 7), (None, 3)] + [(200, k) for k in range(201, 260)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {50: 50, 60: 50, 100: 50} | {k: 200 for k in range(200, 260)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
