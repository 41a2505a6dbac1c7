"""Phrase collocations from the counts of longest windows alone.

Every word of a piece of text opens one window: the word and, in columns beside it that
lead the column of words, the next words up to the longest phrase; at the end of a piece
leads are padded. Only these windows are counted. ROLLUP over the prefixes of a counted
window then sums what shorter phrases need: a phrase occurs as often as windows begin
with it. So no text is cut into n-grams a second time, and what is shuffled has been
summed in its task before.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.llm.common import saved, small
from orderlens.llm.words import byte_table, bytes_of, mix, odd_numbers, slices, split_at_spaces

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters that end a piece; spaces and tabs separate words inside one.
BREAKS = ".,;:!?\n\x0b\x0c\r"
#: Bytes of text whose windows a task counts at a time.
SLICE_BYTES = 4 << 20
#: Words of all texts for which there is one place where windows meet.
PLACE_WORDS = 1_000_000
#: A word is hot if it is at least this part of all words.
HOT_PARTS = 1_000

#: Windows of one place and lang: heads, tails and counts in order, each packed.
WINDOWS = "place int, spread boolean, lang string, heads binary, tails binary, counts binary"
NO_LANG = "und"
#: Factor of the scores, which are whole numbers.
SCALE = 1_000_000


def word_columns(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, piece, word) of all words in order; equal piece numbers mean the same piece of a text."""
    offsets, data = bytes_of(texts)
    table = byte_table(lower=True)
    table[[ord(c) for c in BREAKS]] = ord("\n")
    data = table[data]
    ends = data == ord("\n")
    apart = ends | (data == ord(" "))
    opens = ~apart
    opens[1:] &= apart[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[first] = ~apart[first]
    starts = np.flatnonzero(opens)
    data[ends] = ord(" ")
    owner, words = split_at_spaces(offsets, data)
    return owner, np.cumsum(ends)[starts] + owner, words


def counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of each slice of texts."""
    for batch in batches:
        for _, part in slices(batch.column(0), SLICE_BYTES):
            coded = word_columns(part)[2].dictionary_encode()
            n = np.bincount(np.asarray(coded.indices), minlength=len(coded.dictionary))
            yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.binary()), pa.array(n)], names=["word", "n"])


def counted_windows(longest: int, places: int, hot: set[bytes]):
    """A task's function from (lang, text) to ``WINDOWS``: each window of a slice of texts once.

    The head of a window is all but its last word, which is the tail if the window is a longest one.
    Windows with the same head have the same place, but for heads of ``hot`` words alone.
    """
    factors = odd_numbers(longest + 1, 23)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column(1), SLICE_BYTES):
                owner, piece, words = word_columns(part)
                coded = words.dictionary_encode()
                names = coded.dictionary.cast(pa.binary())
                langs = batch.column(0).slice(first, len(part)).dictionary_encode()
                # The leads of a word are the words behind it in its piece, 0 where there is none.
                leads = [np.asarray(coded.indices, np.int64) + 1]
                for k in range(1, longest):
                    lead = np.zeros(len(piece), np.int64)
                    lead[:-k] = np.where(piece[k:] == piece[:-k], leads[0][k:], 0)
                    leads.append(lead)
                lang = np.asarray(langs.indices, np.int64)[owner]
                key, span, size = lang, max(1, len(langs.dictionary)), len(names) + 1
                for lead in leads:
                    if span * size >= 1 << 62:
                        found, key = np.unique(key, return_inverse=True)
                        span = len(found)
                    key, span = key * size + lead, span * size
                _, at, n = np.unique(key, return_index=True, return_counts=True)
                leads, lang = [lead[at] for lead in leads], lang[at]
                spelled = names.to_pylist()
                hashes = np.array([0] + [xxhash.xxh3_64_intdigest(w) for w in spelled], np.uint64)
                common = np.array([True] + [w in hot for w in spelled])
                # Of the langs the names count, not their numbers in this slice.
                named = np.array([xxhash.xxh3_64_intdigest(x) for x in langs.dictionary.to_pylist()], np.uint64)
                spread = np.logical_and.reduce([common[lead] for lead in leads[:-1]])
                place = named[lang] * factors[0] if len(lang) else np.empty(0, np.uint64)
                for lead, factor in zip(leads[:-1], factors[1:]):
                    place = place + hashes[lead] * factor
                place = mix(place + np.where(spread, hashes[leads[-1]] * factors[-1], np.uint64(0)))
                place = (place % np.uint64(places)).astype(np.int64)
                order = np.lexsort((np.arange(len(n)), spread, lang, place))
                place, lang, spread = place[order], lang[order], spread[order]
                opens = np.ones(len(n), bool)
                opens[1:] = (place[1:] != place[:-1]) | (lang[1:] != lang[:-1]) | (spread[1:] != spread[:-1])
                starts = np.flatnonzero(opens)
                bounds = np.append(starts, len(n))
                columns = [names.take(pa.array(lead[order] - 1, mask=lead[order] == 0)) for lead in leads]
                head = pc.binary_join_element_wise(*columns[:-1], pa.scalar(b" "), null_handling="skip")
                heads, tails = (
                    pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), column), b"\n").to_pylist()
                    for column in (head, pc.fill_null(columns[-1], b""))
                )
                counts = n[order]
                squeeze = zstandard.ZstdCompressor().compress
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place[starts].astype(np.int32)),
                        pa.array(spread[starts]),
                        langs.dictionary.take(pa.array(lang[starts])),
                        pa.array([squeeze(x) for x in heads], pa.binary()),
                        pa.array([squeeze(x) for x in tails], pa.binary()),
                        pa.array([squeeze(counts[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
                    ],
                    names=["place", "spread", "lang", "heads", "tails", "counts"],
                )

    return run


def merged_windows(longest: int, least: int):
    """A task's function from the ``WINDOWS`` of a place to (lang, window, n).

    Windows that occur less than ``least`` times are no phrases: they are padded from the tail
    on, and from the last word of the head on if that begins no phrase, either.
    """

    def lines(packed: bytes) -> pa.Array:
        text = pa.array([zstandard.ZstdDecompressor().decompress(packed)], pa.large_binary())
        return pc.list_flatten(pc.split_pattern(text, b"\n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for spread, lang, heads, tails, counts in zip(*(batch.column(k).to_pylist() for k in range(1, 6))):
                n = np.frombuffer(zstandard.ZstdDecompressor().decompress(counts), np.int64)
                same = [pa.array(np.full(len(n), spread)), pa.DictionaryArray.from_arrays(np.zeros(len(n), np.int32), [lang])]
                parts.append(pa.table([*same, lines(heads), lines(tails), pa.array(n)], names=["spread", "lang", "head", "tail", "n"]))
        if not parts:
            return
        table = pa.concat_tables(parts).unify_dictionaries()
        table = table.set_column(1, "lang", table["lang"].cast(pa.string()))
        table = table.group_by(["spread", "lang", "head", "tail"], use_threads=False).aggregate([("n", "sum")]).combine_chunks()
        head, tail, n = table["head"].combine_chunks(), table["tail"].combine_chunks(), np.asarray(table["n_sum"])
        lang, heads = table["lang"].combine_chunks().dictionary_encode(), head.dictionary_encode()
        key = np.asarray(lang.indices, np.int64) * len(heads.dictionary) + np.asarray(heads.indices)
        found, which = np.unique(key, return_inverse=True)
        rare = (np.bincount(which, n, len(found)) < least)[which] & ~np.asarray(table["spread"])
        rare &= (np.asarray(pc.count_substring(head, b" ")) == longest - 2) & (longest > 2)
        kept = (n >= least) & np.asarray(pc.greater(pc.binary_length(tail), 0))
        whole = pc.binary_join_element_wise(head, tail, pa.scalar(b" ", pa.large_binary()))
        names = heads.dictionary.cast(pa.large_string())
        shorter = pc.replace_substring_regex(names, " [^ ]*$", "").cast(pa.large_binary()).take(heads.indices)
        window = pc.if_else(pa.array(kept), whole, pc.if_else(pa.array(rare), shorter, head))
        out = pa.table([table["lang"], window.cast(pa.large_string()).cast(pa.string()), table["n_sum"]], names=["lang", "window", "n"])
        out = out.group_by(["lang", "window"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["lang", "window", "n"])
        yield from out.to_batches(max_chunksize=1 << 16)

    return run


def windows(docs: DataFrame, longest: int, least: int = 1, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, window, n): for every word of docs the words from it on, up to ``longest`` of its piece, each window once.

    Windows that occur less than ``least`` times are padded earlier, see ``merged_windows``.
    Tasks count their texts first; then the windows of one head meet. A head that
    may be frequent beyond ``1 / HOT_PARTS`` of all words consists of words that are, of which
    there are at most ``HOT_PARTS``: its windows are dealt by all their words and stay as they are.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang")
    words = saved(docs.select(F.col(text_col).alias("text")).mapInArrow(counted_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total = words.agg(F.sum("n")).first()[0] or 0
    hot = {bytes(row["word"]) for row in words.filter(F.col("n") * HOT_PARTS >= total).collect()}
    places = max(1, ceil(total / PLACE_WORDS))
    found = docs.select(lang, F.col(text_col).alias("text")).mapInArrow(counted_windows(longest, places, hot), WINDOWS)
    dealt = found.repartitionById(places, F.col("place"))
    merged = dealt.mapInArrow(merged_windows(longest, least), "lang string, window string, n long")
    return merged.groupBy("lang", "window").agg(F.sum("n").alias("n"))


def phrase_counts(counted: DataFrame, longest: int, least: int = 1) -> DataFrame:
    """(lang, words, phrase, f) of the phrases with f >= least, and n of each lang under words 0.

    counted has (lang, window, n), each window once.
    """
    size = F.char_length("window") - F.char_length(F.translate("window", " ", "")) + 1
    prefixes = [F.when(size >= k, F.substring_index("window", " ", k)).alias(f"p{k}") for k in range(1, longest)]
    names = [f"p{k}" for k in range(1, longest)]
    level = [F.lit(1) - F.grouping(name) for name in names]
    rolled = (
        counted.select("lang", "n", *prefixes)
        .rollup("lang", *names)
        .agg(F.sum("n").alias("f"), sum(level[1:], level[0]).alias("words") if level else F.lit(0).alias("words"), F.grouping("lang").alias("all"))
        .filter("all = 0")
    )
    phrase = F.lit("")
    for k, name in enumerate(names, 1):
        phrase = F.when(F.col("words") == k, F.col(name)).otherwise(phrase)
    # A window shorter than the prefix has none: its rows under null count no phrase.
    shorter = rolled.select("lang", F.col("words").cast("int").alias("words"), phrase.alias("phrase"), "f").filter("phrase is not null")
    shorter = shorter.filter((F.col("f") >= least) | (F.col("words") == 0))
    # One condition on both, so that it stays above the sums and these are shared with ROLLUP.
    whole = counted.filter(F.when(F.col("n") >= least, size == longest)).select("lang", F.lit(longest).alias("words"), F.col("window").alias("phrase"), F.col("n").alias("f"))
    return shorter.unionByName(whole)


def parts_of(phrase: Column, words: Column, longest: int) -> Column:
    """(k, first, rest) for each cut of a phrase after its first k words."""
    cuts = [
        F.struct(F.lit(k).alias("k"), F.substring_index(phrase, " ", k).alias("first"), F.substring_index(phrase, " ", -(m - k)).alias("rest"))
        for m in range(2, longest + 1)
        for k in range(1, m)
    ]
    sizes = [m for m in range(2, longest + 1) for _ in range(1, m)]
    return F.filter(F.array(*[F.when(words == m, c) for m, c in zip(sizes, cuts)]), lambda c: c.isNotNull())


def inner_phrases(phrase: Column, words: Column, longest: int) -> Column:
    """The phrases of two words or more that lie inside a phrase and are shorter than it."""
    inside = [
        F.when(words == m, F.substring_index(F.substring_index(phrase, " ", last), " ", -size))
        for m in range(3, longest + 1)
        for size in range(2, m)
        for last in range(size, m + 1)
    ]
    return F.array_compact(F.array(*inside))


def collocations(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    covered_percent: int = 50,
    first: int = 2000,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's ``first`` phrases by score.

    Phrases have 2 to ``longest`` words and occur a >= ``least`` times in their lang;
    n counts all words of the lang. A cut of a phrase into a first part with l and a rest
    with r occurrences scores floor(1000000 * a * a / (l * r)), exactly as long as a is
    below 10**15; the lowest cut counts, the earlier one of equals. A phrase goes if a
    longer one around it occurs in at least ``covered_percent`` percent of its cases.
    Ranks follow falling score, falling a, and the phrase in byte order.

    Rows without a lang count under ``und``; null and empty texts have no words. Repeated
    rows and ids are rows of their own. An empty table gives no rows; columns other than
    the two named ones are not read.
    """
    if longest < 2:
        raise ValueError(f"phrases have two words or more, got longest = {longest}")
    counts = saved(phrase_counts(windows(docs, longest, least, lang_col, text_col), longest, least))
    totals = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    phrases = counts.filter("words > 0")
    candidates = phrases.filter("words > 1")
    # Parts of a phrase occur at least as often as it does, so they are among the counts.
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), F.inline(parts_of(F.col("phrase"), F.col("words"), longest)))
    known = phrases.select("lang", F.col("phrase").alias("part"), F.col("f"))
    cuts = cuts.join(known.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    # Both products are exact in 38 digits, and so is their whole quotient.
    exact = F.expr(f"(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast({SCALE} as decimal(7,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    lowest = cuts.withColumn("score", exact).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("cut"))
    inner = candidates.filter("words > 2").select("lang", F.col("f").alias("around"), F.explode(inner_phrases(F.col("phrase"), F.col("words"), longest)).alias("phrase"))
    covers = inner.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    covered = F.coalesce(F.col("around"), F.lit(0)) * 100 >= F.col("cut.a") * covered_percent
    kept = saved(lowest.join(covers, ["lang", "phrase"], "left").filter(~covered).select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The first of each bucket, then the first of those: no task sorts all phrases of a lang.
    buckets = max(1, ceil(sqrt(kept.count() / first)))
    kept = kept.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(buckets)))
    near = kept.withColumn("place", F.row_number().over(W.partitionBy("lang", "bucket").orderBy(*order))).filter(F.col("place") <= first)
    ranked = near.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= first)
    return ranked.join(small(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
