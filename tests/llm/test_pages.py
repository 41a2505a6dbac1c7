"""Archives, url rules, vectors, shards, the pipeline and the registered queries."""

import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderlens.llm import host_reputation, pca_tiles, queries, vector_packing, warc
from orderlens.llm.common import run_dir
from tests.llm.helpers import documents, found, prose, texts

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, payload string")


def test_archives_round_trip(spark):
    rows = [
        (1, "u", "x" * 20), (2, "a\r\nb", "é WARC/1.0\r\n evil"), (3, None, FAKE * 3), (4, "u", None), (5, "u", "y" * 1500), (6, "u", "y" * 1500),
        (7, "u", ""), (8, "u", "pre " + (FAKE + "z" * 500) * 30 + " post"), (9, "u", "WARC/1.0\r\n"), (10, "u", "WARC/1.0\r\nContent-Length: 4\r\n\r\n"),
        (11, "v", "t" * 9000), (12, "u", "q" * 1200), (13, "u", "\r\n\r\n"), (None, "u", "q" * 1200),
    ]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        folder = run_dir(spark, "warc-test")
        warc.write_archives(pages(spark, rows).repartition(2), folder)
        read = warc.read_archives(spark, folder).withColumn("id", warc.id_of(F.col("record_id")))
        got = found(read)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert set(got) == {i for i, _, _ in rows}
    for i, _, html in rows:
        if i in (5, None):
            assert got[i].record_type == "revisit"
            assert got[i].payload_digest_header == "sha1:" + hashlib.sha1(html.encode()).hexdigest()
        else:
            assert got[i].record_type == "response" and bytes(got[i].payload) == (html or "").encode()
    assert got[5].refers_to == "<urn:page:6>" and got[2].target_uri == "a%0D%0Ab" and got[3].target_uri is None


def test_archives_of_nothing(spark):
    folder = run_dir(spark, "warc-test")
    warc.write_archives(pages(spark, []), folder)
    assert warc.read_archives(spark, folder).count() == 0


def test_url_parts_and_rules(spark):
    urls = [
        None, "", "no scheme", "http://Example.COM/en/x?q#f", "http://www.example.com/en/", "https://a.net/fr/1", "ftp://x.com", "http://xcom/en/",
        "x://a.b/p://c/en", "http://com/z", "http://example.com#a/en/", "http://ÄB.net/es/\n",
    ]
    rows = [(k, u, "") for k, u in enumerate(urls)] + [(None, "http://a.com/", ""), (3, "http://a.com/", None)]
    outcomes = spark.createDataFrame([("http://a.net/", 1)] * 40 + [("http://example.com/", 0), (None, 1), ("http://q.org", None)], "url string, good int")
    got = host_reputation.judged(pages(spark, rows), outcomes, queries.URL_RULES).collect()
    assert len(got) == len(rows)
    by = {(r.id, r.host): (r.path, r.rule, r.verdict) for r in got}
    assert by[3, "example.com"] == ("/en/x", "example.com/en/", "block")
    assert by[4, "www.example.com"] == ("/en/", "www.example.com/en/", "allow")
    assert by[5, "a.net"] == ("/fr/1", "net/fr/", "block") and by[6, "x.com"][:2] == ("", None) and by[7, "xcom"][1] is None
    assert by[8, "a.b"][0] == "/p://c/en" and by[9, "com"][1] == "com/" and by[10, "example.com"][:2] == ("", None)
    assert by[11, "Äb.net"][:2] == ("/es/\n", "net/es/") and all(by[k, ""][0] == "" for k in range(3))


def test_reputation_is_shrunk_to_its_parents(spark):
    rows = [("a.x.com", 1, 30), ("b.x.com", 0, 1), ("c.y.com", 0, 30), ("d.y.com", 1, 1), ("e.z.org", 1, 2)]
    data = spark.createDataFrame([(h, g) for h, g, n in rows for _ in range(n)], "host string, good int")
    got = {r.host: r for r in host_reputation.reputations(data).collect()}
    assert got["b.x.com"].mean > got["c.y.com"].mean and got["a.x.com"].mean > got["d.y.com"].mean
    assert all(r.bound < r.mean for r in got.values())
    assert host_reputation.reputations(data.limit(0)).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, n int")


@pytest.mark.parametrize("tile", [40, 8192])
def test_near_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(pca_tiles, "TILE_VECTORS", tile)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 24))
    data = np.concatenate((base, base[:20] + rng.normal(scale=0.2, size=(20, 24)), base[:5] * 3, base[:3], base[:1] + rng.normal(scale=0.25, size=(30, 24))))
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(data.astype(np.float32))]
    odd = [(900, None), (901, [0.0] * 24), (902, [None] + [1.0] * 23), (903, [float("nan")] * 24), (904, [1.0] * 3), (905, []), (906, [float("inf")] * 24)]
    got = found(pca_tiles.near_vectors(vectors(spark, rows + odd), 0.95))
    x = data.astype(np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.where(near, label[None, :], len(x)).min(axis=1)
    for k in range(len(x)):
        assert (got[k].n_links, got[k].component, got[k].kept) == (near[k].sum() - 1, label[k], label[k] == k)
    assert all((got[i].n_links, got[i].component, got[i].kept) == (0, i, True) for i, _ in odd)


def test_near_vectors_of_nothing(spark):
    assert pca_tiles.near_vectors(vectors(spark, [])).count() == 0
    got = pca_tiles.near_vectors(vectors(spark, [(None, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0])])).collect()
    assert sorted((str(r.id), r.n_links, r.kept) for r in got) == [("2", 1, True), ("2", 1, True), ("None", 0, True)]


def test_near_vectors_of_several_lengths_and_sizes(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, 4.01]), (3, [5.0, -1.0]), (4, [1.0, 0.0, 1.0]), (5, [3.0, 0.01, 3.0]), (6, [2.0])]
    rows += [(7, [-1.0]), (8, [4.0]), (9, [3e300, 0.0, 3.1e300]), (10, [5e-324, 0.0, 5e-324]), (11, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.id: (r.n_links, r.component) for r in pca_tiles.near_vectors(df, 0.95).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (3, 4), 5: (3, 4), 6: (1, 6), 7: (0, 7), 8: (1, 6), 9: (3, 4), 10: (3, 4), 11: (0, 11)}


def test_placing_balances_all_sizes_together():
    rng = np.random.default_rng(3)
    sizes = np.column_stack((rng.lognormal(6, 1, 4000), rng.lognormal(4, 1, 4000), np.ones(4000)))
    room = np.tile(sizes.sum(axis=0) / 16, (16, 1))
    shard = vector_packing.place(sizes, room, sizes.sum(axis=0) / 16)
    held = np.array([np.bincount(shard, column, 16) for column in sizes.T])
    spread = (held.max(axis=1) - held.min(axis=1)) / held.mean(axis=1)
    assert spread[0] < 1e-3 and spread[1] < 0.05 and spread[2] < 0.02
    assert np.allclose(room, sizes.sum(axis=0) / 16 - held.T)


def check_shards(rows, got, shards):
    slots, size, homes = {}, {}, {}
    for (i, t), r in zip(sorted(rows), sorted(got, key=lambda r: r.id)):
        assert r.id == i and r.size == len((t or "").encode()) + 16
        slots.setdefault(r.shard, []).append(r.slot)
        size[r.shard] = size.get(r.shard, 0) + r.size
        homes.setdefault(t or "", set()).add(r.shard)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(shards))
    return [size.get(s, 0) for s in range(shards)], homes


def test_shards_are_near_equal(spark, monkeypatch):
    monkeypatch.setattr(vector_packing, "CELL_GROUPS", 400)
    monkeypatch.setattr(vector_packing, "LARGE_SHARE", 1 / 8)
    monkeypatch.setattr(vector_packing, "NUMBERED_ROWS", 10)
    rows = list(enumerate([*texts(), *[prose(k, 5 + k % 60) for k in range(1500)], *["copy " * 10] * 20]))
    sizes, homes = check_shards(rows, vector_packing.sharded(documents(spark, rows), 8).collect(), 8)
    assert max(sizes) <= 1.02 * min(sizes) and all(len(h) == 1 for h in homes.values())


def test_a_group_beyond_a_shard_is_cut(spark):
    rows = [(k, "the same text") for k in range(900)] + [(1000 + k, prose(k, 3)) for k in range(100)]
    sizes, homes = check_shards(rows, vector_packing.sharded(documents(spark, rows), 5).collect(), 5)
    assert max(sizes) <= 1.3 * min(sizes) and len(homes["the same text"]) > 1


def test_shards_of_awkward_tables(spark):
    assert vector_packing.sharded(documents(spark, [])).count() == 0
    got = vector_packing.sharded(documents(spark, [(None, None), (3, ""), (3, "")]), 2).collect()
    assert len(got) == 3 and all(r.size == 16 for r in got)


SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(name, spark, sf_dir):
    duck = duckdb.connect()
    for table in ("documents", "pages", "labels"):
        duck.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    df = queries.queries()[name](spark, sf_dir)
    relation = duck.sql(SQL[name])
    columns = sorted(df.columns)
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == sorted(repr(tuple(r[k] for k in order)) for r in relation.fetchall())


def test_pipeline_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = documents(spark, [(-5, "copy of a text " * 30), (-4, "copy of a text " * 30), (-4, "copy of a text " * 30), (-3, None), (None, "mail a@b.cd")])
    docs = docs.unionByName(extra.select(docs.columns[0], "text", "lang", F.lit("s").alias("source"), "n_chars")).withColumn("row_data", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir).checkpoint()
        assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
        docs = kept
    texts_left = [r.text for r in docs.collect()]
    assert sum(t is not None and t.startswith("copy of a text") for t in texts_left) == 1
    assert not any("@" in (t or "") and ".example.com" in t for t in texts_left)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_pipeline_of_nothing(spark, tmp_path, sf_dir):
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
