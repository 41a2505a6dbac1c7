"""The operators over whole tables with production parameters, and SQL twins where SQL can say it."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (
    attention_lm,
    exact_dedup,
    host_reputation,
    minhash_hamming,
    packing_ga,
    pca_tiles,
    phrase_rollup,
    piece_codec,
    positive_unlabelled,
    radix_audit,
    vector_packing,
    warc,
    weak_pii,
)
from orderlens.llm.common import remove_dir, run_dir, saved


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    records = warc.read_archives(
        spark, folder, {"payload_bytes": lambda p: F.octet_length(p).cast("long"), "payload_digest": lambda p: F.sha1(p)}
    )
    records = saved(
        records.select(
            warc.id_of(F.col("record_id")).alias("page_id"),
            "payload_bytes",
            "payload_digest",
            "record_type",
            warc.id_of(F.col("refers_to")).alias("refers_to"),
        )
    )
    remove_dir(spark, folder)
    responses = records.filter("record_type = 'response'")
    full = responses.groupBy(F.col("page_id").alias("refers_to")).agg(
        F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest")
    )
    # A revisit has no payload of its own: it takes the length and digest of the one it refers to.
    revisits = records.filter("record_type = 'revisit'").select("page_id", "record_type", "refers_to").join(full, "refers_to", "left")
    return responses.unionByName(revisits)


def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weak_pii.personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def joined(spans: Column) -> Column:
        names = F.array(*[F.lit(k) for k in weak_pii.KINDS])
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, F.lit(k))) for k in range(len(weak_pii.KINDS))]
    counts = [(F.size(kinds) - c).cast("long").alias(f"n_{name}") for c, name in zip(counts, weak_pii.KINDS)]
    return found.select(
        F.col("id").alias("doc_id"), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


#: Labels are learnt only from documents whose crc32 of the id as text leaves a remainder here.
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    found = positive_unlabelled.quality_scores(
        table(spark, sf_dir, "documents"),
        positives=labels.filter("quality = 1").select("doc_id"),
        labelled=labels.select("doc_id"),
        fit_on=~held_out(F.col("id")),
    )
    return found.select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def rows_of(lists: pa.ListArray) -> list[list[int]]:
    flat, offsets = np.asarray(pc.list_flatten(lists)).tolist(), np.asarray(lists.offsets).tolist()
    return [flat[a - offsets[0] : b - offsets[0]] for a, b in zip(offsets[:-1], offsets[1:])]


def piece_digests(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Counts and digests of encoded documents."""
    ids = rows_of(batch.column("ids"))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("id"),
            pa.array([len(i) for i in ids], pa.int64()),
            pa.array([hashlib.sha256(",".join(map(str, i)).encode()).hexdigest() for i in ids], pa.string()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in batch.column("decoded").to_pylist()], pa.string()),
        ],
        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


def pieces_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encoded(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("piece_bpe_32k.model"),
        finish=piece_digests,
        schema="doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


#: Rules of the URL filter: host, start of the path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: A page counts as good if it has this many paragraphs.
LEAST_PARAGRAPHS = 5


def url_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    paragraphs = F.octet_length("html") - F.octet_length(F.replace("html", F.lit("<p>"), F.lit("")))
    outcomes = pages.select("url", (paragraphs >= 3 * LEAST_PARAGRAPHS).cast("int").alias("good"))
    found = host_reputation.judged(pages, outcomes, URL_RULES)
    return found.drop("bound").withColumnRenamed("id", "page_id")


def vectors_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pca_tiles.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)
    return found.withColumnRenamed("id", "vec_id").withColumnRenamed("component", "component_id")


def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_packing.sharded(table(spark, sf_dir, "documents"), shards=40)
    return found.withColumnRenamed("id", "doc_id").withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def minhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_hamming.near_duplicates(table(spark, sf_dir, "documents"), words=5, percent=85)
    return found.withColumnRenamed("id", "doc_id").withColumnRenamed("component", "component_id")


CAPACITY = 2048


def length_digests(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Lengths and checksums of token pieces."""
    lists = batch.column("ids")
    flat, offsets = np.asarray(pc.list_flatten(lists)).astype("<u4"), np.asarray(lists.offsets)
    checks = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(k) for k in ("id", "piece", "start")), pa.array(np.diff(offsets).astype(np.int64)), pa.array(checks, pa.int64())],
        names=["id", "piece", "start", "length", "ids_crc32"],
    )


def packing_of(docs: DataFrame) -> DataFrame:
    """The contract's columns for a table of documents."""
    pieces = packing_ga.token_pieces(
        docs,
        public_tokenizers.path("word_bpe_49k.json"),
        CAPACITY,
        finish=length_digests,
        schema="id long, piece int, start long, length long, ids_crc32 long",
    )
    return packing_ga.packed(pieces, CAPACITY).withColumnRenamed("id", "doc_id")


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_of(table(spark, sf_dir, "documents"))


def phrases_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_rollup.collocations(table(spark, sf_dir, "documents"), longest=3, least=10, covered_percent=50, first=2000)


def audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def language_model_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = attention_lm.scored(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folds=10)
    return found.withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query per operator; each takes (spark, folder of the tables)."""
    return {
        "op1_warc_chain": warc_query,
        "op2_exact_dedup": exact_dedup_query,
        "op3_weak_pii": pii_query,
        "op4_positive_unlabelled": quality_query,
        "op5_piece_codec": pieces_query,
        "op6_host_reputation": url_query,
        "op7_pca_tiles": vectors_query,
        "op8_vector_packing": sharding_query,
        "op9_minhash_hamming": minhash_query,
        "op10_packing_ga": packing_query,
        "op11_phrase_rollup": phrases_query,
        "op12_radix_audit": audit_query,
        "op13_attention_lm": language_model_query,
    }


#: DuckDB's regexes know no look-behind or possessive groups; their plain forms match the same.
SPACE_CHARS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

WARC_SQL = """
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
), kept AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS keeper FROM rows
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN keeper END AS refers_to
FROM kept
"""

EXACT_DEDUP_SQL = f"""
WITH rows AS (
  SELECT doc_id, coalesce(text, '') AS text, translate(coalesce(text, ''), {SPACE_CHARS_SQL}, '') AS norm FROM documents
), ranked AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id
  FROM rows
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM ranked
"""

RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
LONG_SQL = ", ".join(f"'{x}'" for x in host_reputation.LONG_SUFFIXES)


def strength_sql(children: str, parent: str) -> str:
    """The prior strength of a level, as a query of one row."""
    limits = f"least(greatest((1 - r) / nullif(r, 0), {host_reputation.WEAKEST}), {host_reputation.STRONGEST})"
    return f"""(SELECT CASE WHEN between_ > inside THEN {limits} ELSE {host_reputation.STRONGEST} END FROM (
  SELECT *, (between_ - inside) / nullif(between_ + (spread / free - 1) * inside, 0) AS r FROM (
    SELECT free, spread, b / free AS between_, i / greatest(rest, 1) AS inside FROM (
      SELECT nullif(sum(g - 1), 0) AS free, sum(n - g) AS rest, sum(k2 - k * k / n) AS b, sum(k - k2) AS i, sum(n - n2 / n) AS spread
      FROM (SELECT count(*) AS g, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(k) AS DOUBLE) AS k, sum(CAST(n AS DOUBLE) * n) AS n2,
                   sum(CAST(k AS DOUBLE) * k / n) AS k2 FROM {children} GROUP BY {parent})))))"""


URL_SQL = f"""
WITH cut AS (
  SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{host_reputation.UPPER}', '{host_reputation.LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), named AS (
  SELECT *, regexp_extract(host, '[^.]*$') AS last, regexp_extract(host, '([^.]*\\.)?[^.]*$') AS two FROM parts
), hosts AS (
  SELECT host, CASE WHEN two IN ({LONG_SQL}) THEN regexp_extract(host, '([^.]*\\.){{0,2}}[^.]*$') ELSE two END AS domain,
         CASE WHEN two IN ({LONG_SQL}) THEN two ELSE last END AS suffix, CAST(count(*) AS DOUBLE) AS n,
         CAST(count(*) FILTER (length(html) - length(replace(html, '<p>', '')) >= {3 * LEAST_PARAGRAPHS}) AS DOUBLE) AS k
  FROM named WHERE html IS NOT NULL GROUP BY ALL
), domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY ALL),
numbers AS (
  SELECT (SELECT sum(k) / sum(n) FROM suffixes) AS m, {strength_sql("suffixes", "()")} AS c1,
         {strength_sql("domains", "suffix")} AS c2, {strength_sql("hosts", "domain")} AS c3
), shrunk AS (
  SELECT host, h.k + c3 * d.mean AS a, h.n - h.k + c3 * (1 - d.mean) AS b
  FROM hosts h, numbers, (
    SELECT domain, (d.k + c2 * s.mean) / (d.n + c2) AS mean
    FROM domains d JOIN (SELECT suffix, (k + c1 * m) / (n + c1) AS mean FROM suffixes, numbers) s USING (suffix), numbers
  ) d
  WHERE h.domain = d.domain
), bounds AS (
  SELECT host, a / (a + b) - {host_reputation.MARGIN} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM shrunk
), rules AS (SELECT * FROM (VALUES {RULES_SQL}) AS r(rule_host, rule_path, what))
SELECT page_id, host, path, found.rule, coalesce(found.what, CASE WHEN bound >= {host_reputation.LEAST_GOOD} THEN 'allow' ELSE 'block' END) AS verdict
FROM parts LEFT JOIN bounds USING (host) LEFT JOIN (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(what, length(rule_host || rule_path)) AS what
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id
) found USING (page_id)
"""


BREAKS_SQL = "'.,;:!?' || chr(11) || chr(12) || chr(13) || chr(9)"

PHRASES_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split(translate(coalesce(text, ''), '{phrase_rollup.UPPER}' || {BREAKS_SQL},
    '{phrase_rollup.LOWER}' || repeat(chr(10), 9) || ' '), chr(10))) AS piece FROM documents
), words AS (
  SELECT lang, row_number() OVER () AS piece, unnest(string_split(piece, ' ')) AS word, generate_subscripts(string_split(piece, ' '), 1) AS nth FROM pieces
), led AS (
  SELECT lang, word, lead(word) OVER w AS second, lead(word, 2) OVER w AS third FROM words WHERE word <> '' WINDOW w AS (PARTITION BY piece ORDER BY nth)
), f AS (
  SELECT lang, 1 AS m, word AS first, '' AS rest, word AS phrase, count(*) AS f FROM led GROUP BY lang, word
  UNION ALL SELECT lang, 2, word, second, word || ' ' || second, count(*) FROM led WHERE second IS NOT NULL GROUP BY lang, word, second
  UNION ALL SELECT lang, 3, word || ' ' || second, second || ' ' || third, word || ' ' || second || ' ' || third, count(*)
    FROM led WHERE third IS NOT NULL GROUP BY lang, word, second, third
), c AS (SELECT * FROM f WHERE m > 1 AND f >= 10),
cuts AS (
  SELECT lang, phrase, f AS a, 1 AS k, split_part(phrase, ' ', 1) AS one, rest AS other FROM c
  UNION ALL SELECT lang, phrase, f, 2, first, split_part(phrase, ' ', 3) FROM c WHERE m = 3
), scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r, CAST(1000000 AS HUGEINT) * a * a // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = one JOIN f y ON y.lang = cuts.lang AND y.phrase = other
), lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored) WHERE place = 1
), around AS (
  SELECT lang, phrase, max(f) AS most FROM (SELECT lang, first AS phrase, f FROM c WHERE m = 3 UNION ALL SELECT lang, rest, f FROM c WHERE m = 3) GROUP BY ALL
), kept AS (
  SELECT lowest.lang, lowest.phrase, a, l, r, score FROM lowest LEFT JOIN around ON around.lang = lowest.lang AND around.phrase = lowest.phrase
  WHERE 100 * coalesce(most, 0) < 50 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
), totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang)
SELECT ranked.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
"""

AUDIT_SQL = """
WITH rows AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split(translate(coalesce(text, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '), lambda x: x <> '') AS words
  FROM documents
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(marks.toxic, 0) AS toxic,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 3 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN length(translate(text, '#$%&*|', '')) < length(text) THEN 8 ELSE 0 END
         + CASE WHEN rows.doc_id > min(rows.doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM rows LEFT JOIN marks ON marks.doc_id = rows.doc_id
), sums AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, mask
), names AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS names(name, bit)),
orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM names a, names b, names c, names d, names e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, list_sum(bits[1:step]) - bits[step] AS before FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), counted AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM (SELECT part, mask, n, good, toxic, filter_order, step, bit, CAST(before AS INTEGER) AS before FROM sums, steps) GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""


def oracle_sql() -> dict[str, str]:
    """SQL that gives the same rows, for the queries that SQL can express."""
    return {"op1_warc_chain": WARC_SQL, "op2_exact_dedup": EXACT_DEDUP_SQL, "op6_host_reputation": URL_SQL, "op11_phrase_rollup": PHRASES_SQL, "op12_radix_audit": AUDIT_SQL}
