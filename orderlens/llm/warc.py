"""Web archives: WARC files written and read by Spark, records found by chain verification.

Files are written as text whose line separator is the end of a record, so every task
streams its records out. They are read as text separated by the magic that begins
a record, in splits of bounded size. Each piece gives a candidate: the place of the magic
and, from its header's length, the place where the next record must begin. Candidates
inside payloads exist too. Within a split the chains are followed to where they leave
it; across splits, pointer jumping from the start of each file finds the one chain that
is real, and only records on it are kept.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.llm.common import filled, saved, small

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
#: Payloads from this many bytes on are stored once.
LEAST_REVISIT = 1000


def header(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: int = LEAST_REVISIT,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write one WARC record per row into ``folder``, a file per task.

    A null html is an empty payload, a null url has no target line; line breaks in a
    url are percent-encoded. Of rows with equal payloads of at least ``least`` bytes that
    with the largest id is a response and the others are revisits that refer to it;
    rows with the same id are alike. A null id is written as an empty name and never
    referred to unless its group has no other. An empty table writes no record.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), filled(html_col).alias("payload")
    ).withColumn("bytes", F.octet_length("payload"))
    keyed = rows.filter(F.col("bytes") >= least).select("id", F.unhex(F.sha2("payload", 256)).alias("key"))
    groups = keyed.groupBy("key").agg(F.max("id").alias("keeper"), F.count("*").alias("n")).filter("n > 1").select("key", "keeper")
    key = F.when(F.col("bytes") >= least, F.unhex(F.sha2("payload", 256)))
    known = rows.withColumn("key", key).join(small(saved(groups)), "key", "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes"), F.lit(END))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    record = F.concat(
        F.lit(MAGIC),
        header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", name(F.col("id"))),
        header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", url),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload"))),
        header("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
        header("WARC-Refers-To", F.when(revisit, name(F.col("keeper")))),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
        F.col("block"),
    )
    known.withColumn("block", block).select(record.alias("value")).write.option("lineSep", END).option("compression", "none").text(folder)


def value_of(head: Column, name: str) -> Column:
    """A header's value, null where it is missing."""
    found = F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def id_of(name: Column) -> Column:
    return F.regexp_extract(name, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def parsed(of_payload: dict[str, Callable[[Column], Column]]) -> dict[str, Column]:
    """Columns of a record from its text behind the magic."""
    value, head = F.col("value"), F.substring_index("value", END, 1)
    block = F.substring(value.cast("binary"), F.octet_length(head) + 5, F.col("block_bytes"))
    http_bytes = F.octet_length(F.substring_index(block.cast("string"), END, 1)) + 4
    payload = F.substring(block, http_bytes + 1, F.col("block_bytes"))
    return {
        "record_type": value_of(head, "WARC-Type"),
        "record_id": value_of(head, "WARC-Record-ID"),
        "target_uri": value_of(head, "WARC-Target-URI"),
        "refers_to": value_of(head, "WARC-Refers-To"),
        "payload_digest_header": value_of(head, "WARC-Payload-Digest"),
    } | {name: of(payload) for name, of in of_payload.items()}


def read_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """(value, file, split, n, bytes): text between magics, with its split and its order there.

    The numbers n depend on the files and the session's settings alone.
    """
    lines = spark.read.option("lineSep", MAGIC).text(folder)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("n"),
        F.octet_length("value").cast("long").alias("bytes"),
    )


def candidates(spark: SparkSession, folder: str, of_payload: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """A row per piece of text between magics, with the place of its magic and its successor.

    ``whole`` tells that the piece is exactly one record; its columns are then parsed
    where it was read.
    """
    head = F.substring_index("value", END, 1)
    lines = read_pieces(spark, folder).withColumn("head_bytes", F.octet_length(head))
    lines = lines.withColumn("block_bytes", F.when(F.col("head_bytes") < F.col("bytes"), value_of(head, "Content-Length").try_cast("int")))
    lines = lines.withColumn("whole", F.coalesce(F.col("head_bytes") + F.col("block_bytes") + 8 == F.col("bytes"), F.lit(False)))
    rows = saved(
        lines.select(
            "file", "split", "n", "bytes", "head_bytes", "block_bytes", "whole",
            *[F.when(F.col("whole"), c).alias(k) for k, c in parsed(of_payload).items()],
        )
    )
    width = F.col("bytes") + len(MAGIC)
    lengths = rows.groupBy("file", "split").agg(F.sum(width).alias("total"))
    so_far = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    bases = lengths.select("file", "split", F.coalesce(F.sum("total").over(so_far), F.lit(0)).alias("base"))
    within = W.partitionBy("file", "split").orderBy("n").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.join(small(bases), ["file", "split"]).withColumn("at", F.col("base") + F.coalesce(F.sum(width).over(within), F.lit(0)) - len(MAGIC))
    following = F.when(F.col("block_bytes").isNotNull() & (F.col("at") >= 0), F.col("at") + len(MAGIC) + F.col("head_bytes") + F.col("block_bytes") + 8)
    return saved(placed.withColumn("next", following))


def left_at(key: tuple, table: pa.Table) -> pa.Table:
    """For each candidate of a split, where its chain leaves the split; null if it breaks."""
    at, after = table["at"].to_pylist(), table["next"].to_pylist()
    last, out = max(at), {}
    for place, follower in sorted(zip(at, after), reverse=True):
        out[place] = follower if follower is None or follower > last else out.get(follower)
    n = len(at)
    return pa.table({"file": [key[0].as_py()] * n, "at": at, "out": pa.array([out[a] for a in at], pa.int64())})


def on_chain(key: tuple, table: pa.Table, entry: pa.Table) -> pa.Table:
    """The places in a split that its real entry leads to."""
    found, follower = [], dict(zip(table["at"].to_pylist(), table["next"].to_pylist()))
    place = min(entry["entry"].to_pylist(), default=None)
    while place in follower:
        found.append(place)
        place = follower[place]
    return pa.table({"file": pa.array([key[0].as_py()] * len(found), pa.string()), "at": pa.array(found, pa.int64())})


def real_records(rows: DataFrame) -> DataFrame:
    """(file, at) of the records that the start of their file leads to."""
    nodes = rows.filter("next is not null").select("file", "split", "at", "next")
    jumps = saved(nodes.groupBy("file", "split").applyInArrow(left_at, "file string, at long, out long"))
    targets = jumps.select("file", F.col("out").alias("at")).filter("at is not null").distinct()
    starts = nodes.filter("at = 0").select("file", "at")
    jumps = saved(jumps.join(targets.unionByName(starts).distinct(), ["file", "at"], "left_semi"))
    reached, count = saved(starts), 0
    while (now := reached.count()) > count:
        count = now
        ahead = reached.join(jumps, ["file", "at"]).select("file", F.col("out").alias("at"))
        reached = saved(reached.unionByName(ahead).distinct().join(nodes.select("file", "at"), ["file", "at"], "left_semi"))
        further = jumps.select("file", F.col("at").alias("out"), F.col("out").alias("far"))
        jumps = saved(jumps.join(further, ["file", "out"]).select("file", "at", F.col("far").alias("out")).filter("out is not null"))
    entries = saved(reached.join(nodes.select("file", "split", "at"), ["file", "at"])).toDF("in_file", "entry", "in_split")
    return nodes.groupBy("file", "split").cogroup(entries.groupBy("in_file", "in_split")).applyInArrow(on_chain, "file string, at long")


def read_archives(spark: SparkSession, folder: str, of_payload: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """(file, at, next, record_type, record_id, target_uri, refers_to, payload_digest_header, ...) per record.

    ``of_payload`` names what is computed from each payload (binary) where it is read;
    by default the payload itself. Text that no chain from a file's start reaches is
    not returned; a file that does not begin with the magic has no records.
    """
    of_payload = of_payload or {"payload": lambda p: p}
    rows = candidates(spark, folder, of_payload)
    chain = saved(real_records(rows).withColumn("real", F.lit(True)))
    rows = saved(rows.join(chain, ["file", "at"], "left").withColumn("real", F.coalesce("real", F.lit(False))))
    names = list(parsed(of_payload))
    whole = rows.filter("real and whole").select("file", "at", "next", *names)
    # Records whose payload holds the magic: their pieces, from this split or from later ones.
    before = W.partitionBy("file", "split").orderBy("n").rowsBetween(W.unboundedPreceding, W.currentRow)
    pieces = rows.withColumn("owner", F.last(F.when(F.col("real"), F.col("at")), ignorenulls=True).over(before))
    broken = rows.filter("real and not whole").select("file", F.col("at").alias("owner"), F.col("next").alias("stop"), "block_bytes")
    if broken.isEmpty():
        return whole
    early = pieces.filter("owner is null and at >= 0").drop("owner")
    bases = rows.groupBy("file", "split").agg(F.min("base").alias("base"))
    crossing = broken.join(bases, "file").filter(f"base > owner and base <= stop + {len(MAGIC)}").select("file", "split", "owner")
    place = ["file", "split", "n", "bytes"]
    held = pieces.filter("owner is not null").select("owner", "at", *place)
    held = held.unionByName(early.join(crossing, ["file", "split"]).select("owner", "at", *place))
    held = saved(held.join(broken, ["file", "owner"]).filter("at < stop"))
    texts = read_pieces(spark, folder).join(small(held), place)
    parts = F.array_sort(F.collect_list(F.struct("at", "value")))
    joined = texts.groupBy("file", "owner", "stop", "block_bytes").agg(F.array_join(F.transform(parts, lambda p: p["value"]), MAGIC).alias("value"))
    exact = F.octet_length("value") + len(MAGIC) == F.col("stop") - F.col("owner")
    joined = joined.withColumn("value", F.when(exact, F.col("value")).otherwise(F.raise_error(F.lit("archives changed while they were read"))))
    mended = joined.select("file", F.col("owner").alias("at"), F.col("stop").alias("next"), *[c.alias(k) for k, c in parsed(of_payload).items()])
    return whole.unionByName(mended)
