"""Personal data in texts: labelers vote, EM weighs them, a classifier decides spans.

Regular expressions give the base spans, which always stay, and wider shapes give
further candidates. On every candidate five labelers vote for, against or not at
all: validity of the shape, a gazetteer, words of the context, the border of the
span, and a checksum or size rule. Expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is for each kind. A logistic model over
votes and shape, fitted to the resulting probabilities, is the final classifier: a
candidate beyond the base is added where it is sure enough and overlaps no span.

Only DataFrame functions touch the texts. What the driver sees are counts per
pattern, of which there are ``4 kinds * 3**5 votes * 8 lengths`` at most.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.llm.common import filled, saved

KINDS = ("email", "ip", "card", "phone")

#: Base shapes, one per kind. Possessive groups and look-behinds keep the search
#: linear and find the same leftmost matches as the plain forms: a run that fails
#: from its start, or from the end of the last match, also fails from within.
BASE = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[ -]?[0-9])++",
    r"\+[0-9][ ().0-9-]+[0-9]",
)
#: Wider shapes: spelled-out addresses, long internet addresses, shorter cards, national numbers.
WIDER = (
    r"[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]{2,24})++",
    r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    r"(?<![0-9])[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}(?![0-9])",
    r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
)
#: What a text must have for a shape to be searched at all.
HINTS = ("@", r"[0-9]\.[0-9]", r"[0-9](?:[ -]?[0-9]){11}", "+")
WIDER_HINTS = (r"[\[(] ?at ?[\])]", r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:", r"[0-9]{6}[ -][0-9]", r"[0-9]{3}[ .-][0-9]{4}")
#: Fixed lists of the gazetteer: endings of hosts, and first digits of calling codes and cards.
HOST_ENDINGS = "com|org|net|edu|gov|info|biz|io|eu|de|fr|es|it|nl|uk|us|ca|au|ch|at|be|se|pl|cn|jp|in|br|mx"
CALLING_CODES = r"\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
CARD_STARTS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65|62)"
#: Fixed cue words before a span, for and against.
CUES = (
    r"(?i)(?:e-?mail|mail|contact|write|correo|courriel)[^A-Za-z]{0,12}\S{0,12}$",
    r"(?i)(?:\bip\b|address|host|server|client|adresse)[^0-9]{0,12}$",
    r"(?i)(?:card|visa|master|amex|credit|karte|carte|tarjeta)[^0-9]{0,12}$",
    r"(?i)(?:phone|tel|call|mobile|fax|telefon|llame)[^0-9]{0,12}$",
)
AGAINST = r"(?i)(?:version|isbn|issn|doi|fig|figure|section|chapter|token|password|order|serial|no\.|id)[\s:=#\"]{0,4}\S{0,4}$"

VOTES = ("valid", "gazetteer", "context", "border", "checksum")
LENGTHS = 8
CONTEXT = 40
EM_ROUNDS = 50
FIT_STEPS = 300
#: Probability from which a candidate beyond the base is added.
SURE = 0.9


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.split(F.reverse(number), "")
    sums = F.transform(
        F.filter(places, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(sums, F.lit(0), lambda a, b: a + b) % 10 == 0


def matches(docs: DataFrame) -> DataFrame:
    """A row for every match of a shape in (row, text, ...), and one of shape -1 for every row.

    Places come from the pieces between matches: a match begins behind the lengths of
    all pieces and matches before it.
    """
    text, shapes = F.col("text"), list(zip(BASE + WIDER, HINTS + WIDER_HINTS))
    others = [c for c in docs.columns if c != "text"]

    def hinted(hint: str) -> Column:
        return F.contains(text, F.lit(hint)) if len(hint) == 1 else text.rlike(hint)

    hits = docs.select(
        *docs.columns,
        *[F.when(hinted(h), F.regexp_extract_all(text, F.lit(p), F.lit(0))).alias(f"hit{k}") for k, (p, h) in enumerate(shapes)],
    )
    cut = hits.select(
        *docs.columns,
        *[f"hit{k}" for k in range(len(shapes))],
        *[F.when(F.size(f"hit{k}") > 0, F.split(text, p, -1)).alias(f"gap{k}") for k, (p, _) in enumerate(shapes)],
    )

    def listing(k: int) -> Column:
        gaps = F.col(f"gap{k}")
        behind = F.slice(gaps, 2, F.greatest(F.size(gaps), F.lit(1)))
        zipped = F.arrays_zip(F.col(f"hit{k}").alias("hit"), gaps.alias("gap"), behind.alias("next"))
        structs = F.transform(
            zipped, lambda z, i: F.struct(F.lit(k).alias("shape"), i.alias("k"), z["hit"].alias("hit"), z["gap"].alias("gap"), z["next"].alias("next"))
        )
        return F.filter(structs, lambda z: z["hit"].isNotNull())

    parts = [listing(k) for k in range(len(shapes))]
    empty = F.lit(None).cast("string")
    mark = F.array(F.struct(F.lit(-1).alias("shape"), F.lit(0).alias("k"), empty.alias("hit"), F.lit("").alias("gap"), empty.alias("next")))
    listed = F.concat(mark, *[F.coalesce(p, F.slice(mark, 1, 0)) for p in parts])
    rows = cut.select(*others, F.col("text"), F.explode(listed).alias("m"))
    rows = rows.select(
        *others,
        F.when(F.col("m.shape") == -1, F.col("text")).alias("text"),
        "m.shape",
        "m.k",
        "m.hit",
        (F.char_length("m.gap") + F.coalesce(F.char_length("m.hit"), F.lit(0))).alias("step"),
        F.right("m.gap", F.lit(CONTEXT)).alias("before"),
        F.left("m.next", F.lit(CONTEXT)).alias("after"),
    )
    so_far = W.partitionBy("row", "shape").orderBy("k").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = rows.repartition("row").withColumn("end", F.sum("step").over(so_far).cast("int"))
    return placed.withColumn("start", F.col("end") - F.char_length("hit"))


def voted(found: DataFrame) -> DataFrame:
    """The matches with their kind, base flag, votes and length class."""
    hit, before, number = F.col("hit"), F.col("before"), digits(F.col("hit"))
    count = F.length(number)
    long_enough = F.element_at(F.array(F.lit(1), F.lit(4), F.lit(13), F.lit(7)), F.pmod("shape", F.lit(len(KINDS))) + 1)
    kind = F.when((F.col("shape") >= 0) & (F.col("shape").isin(0, 4, 5) | (count >= long_enough)), F.col("shape") % len(KINDS))
    base_shape = F.col("shape") < len(KINDS)
    octets = F.transform(F.split(hit, r"\."), lambda o: o.rlike("^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})$"))

    def by_kind(email: Column, ip: Column, card: Column, phone: Column) -> Column:
        return F.when(kind == 0, email).when(kind == 1, ip).when(kind == 2, card).when(kind == 3, phone)

    def vote(yes: Column, no: Column) -> Column:
        return F.when(yes, 1).when(no, -1).otherwise(0)

    valid = by_kind(
        F.lit(True),
        F.forall(octets, lambda o: o),
        F.when(count.between(16, 19), luhn(number)).otherwise(False),
        count.between(8, 15),
    )
    address = ~F.contains(hit, F.lit(":"))
    listed = by_kind(
        hit.rlike(rf"(?i)(?:\.|dot ?[\])] ?)(?:{HOST_ENDINGS})$"),
        hit.rlike(r"^0*(?:[1-9]|1[1-9]|[2-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\.") & ~hit.rlike(r"^0*127\.") | ~address,
        number.rlike(CARD_STARTS),
        hit.rlike(CALLING_CODES) | hit.rlike(r"^\(?[2-9]"),
    )
    checked = by_kind(
        hit.rlike("[A-Za-z]"),
        F.when(address, F.forall(octets, lambda o: o)).otherwise(True),
        F.when(count.between(13, 19), luhn(number)).otherwise(False),
        count.between(10, 13),
    )
    cue = by_kind(*[before.rlike(c) for c in CUES])
    glued = before.rlike(r"[A-Za-z0-9_=#/]$") | F.col("after").rlike(r"^(?:[A-Za-z0-9_]|[.,-][0-9])")
    return found.select(
        "*",
        kind.alias("kind"),
        (base_shape & valid).alias("base"),
        vote(base_shape & valid, base_shape & ~valid).alias("valid"),
        vote(listed, ~listed).alias("gazetteer"),
        vote(cue & ~before.rlike(AGAINST), before.rlike(AGAINST)).alias("context"),
        vote(~glued, glued).alias("border"),
        vote(checked, ~checked).alias("checksum"),
        F.least(F.floor(F.char_length("hit") / 4), F.lit(LENGTHS - 1)).cast("int").alias("size"),
    )


def reliabilities(counts: dict[tuple, int]) -> dict[tuple, float]:
    """The probability that a candidate is personal data for each (kind, *votes), by EM.

    Each kind has a share of true candidates, and each labeler a distribution of votes on
    true and on false ones; labelers are independent given the truth. It starts from the
    share of votes in favour.
    """
    chance = {k: (1 + sum(v > 0 for v in k[1:])) / (2 + sum(v != 0 for v in k[1:])) for k in counts}
    for _ in range(EM_ROUNDS):
        share: dict = {}
        seen: dict = {}
        for k, n in counts.items():
            for truth, p in ((1, chance[k]), (0, 1 - chance[k])):
                share[k[0], truth] = share.get((k[0], truth), 1.0) + n * p
                for at, v in enumerate(k[1:]):
                    cell = k[0], truth, at, v
                    seen[cell] = seen.get(cell, 0.0) + n * p
        for k in counts:
            odds = []
            for truth in (1, 0):
                total = share[k[0], truth]
                odds.append(math.log(total) + sum(math.log((seen.get((k[0], truth, at, v), 0.0) + 1) / (total + 2)) for at, v in enumerate(k[1:])))
            chance[k] = 1 / (1 + math.exp(max(-500.0, min(500.0, odds[1] - odds[0]))))
    return chance


def features(kind: int, votes: tuple, size: int) -> list[str]:
    """Names of the classifier's features that a candidate has."""
    return [f"{kind}", f"{kind}size{size}"] + [f"{kind}{name}{v}" for name, v in zip(VOTES, votes)]


def classifier(counts: dict[tuple, int]) -> dict[str, float]:
    """Weights of a logistic model of the EM probabilities; keys of counts are (kind, *votes, size)."""
    patterns: dict[tuple, int] = {}
    for k, n in counts.items():
        patterns[k[:-1]] = patterns.get(k[:-1], 0) + n
    chance = reliabilities(patterns)
    rows = [(features(k[0], k[1:-1], k[-1]), n, chance[k[:-1]]) for k, n in sorted(counts.items())]
    total = sum(n for _, n, _ in rows) or 1
    weights = {f: 0.0 for names, _, _ in rows for f in names}
    squares = dict.fromkeys(weights, 1e-8)
    for _ in range(FIT_STEPS):
        slope = {f: 1e-4 * w for f, w in weights.items()}
        for names, n, p in rows:
            error = (1 / (1 + math.exp(-sum(weights[f] for f in names))) - p) * n / total
            for f in names:
                slope[f] += error
        for f, g in slope.items():
            squares[f] += g * g
            weights[f] -= 0.5 * g / math.sqrt(squares[f])
    return weights


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(id, spans, cuts) for every row of docs, and ``keep`` columns of it as struct ``row_data``.

    spans are structs (kind, start, end, base) by kind as in ``KINDS`` and start, in code
    points with the end exclusive; base ones come from the fixed shapes alone. cuts are
    the parts (kind, start, end) of the text that spans cover, by place and without
    overlaps. Null and empty texts have no spans. Every row is searched by itself, so rows
    that repeat an id or have none are answered one by one.
    """
    data = F.struct(*keep) if keep else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), filled(text_col).alias("text"), data.alias("row_data"))
    suspect = F.contains(F.col("text"), F.lit("@")) | F.col("text").rlike(r"[0-9]|[\[(] ?at ?[\])]")
    span = "array<struct<kind:int,start:int,end:int,base:boolean>>"
    clean = rows.filter(~suspect).select("id", F.array().cast(span).alias("spans"), F.array().cast("array<struct<kind:int,start:int,end:int>>").alias("cuts"), "row_data")
    marked = rows.filter(suspect).withColumn("row", F.monotonically_increasing_id())
    found = voted(matches(marked.select("row", "id", F.struct("row_data").alias("row_data"), "text")))
    first = F.col("shape") == -1
    found = saved(
        found.select(
            "row", F.when(first, F.col("id")).alias("id"), F.when(first, F.col("row_data")).alias("row_data"), "shape", "kind", "base", "start", "end", *VOTES, "size"
        )
    )
    counted = found.filter("kind is not null").groupBy("kind", *VOTES, "size").count().collect()
    weights = classifier({tuple(r)[:-1]: r["count"] for r in counted})
    terms = [F.concat(F.col("kind")), F.concat("kind", F.lit("size"), "size")] + [F.concat("kind", F.lit(v), v) for v in VOTES]
    table = F.create_map(*[F.lit(x) for pair in (weights or {"": 0.0}).items() for x in pair])
    logit = reduce(lambda a, b: a + b, [F.coalesce(table[t.cast("string")], F.lit(0.0)) for t in terms])
    sure = F.col("kind").isNotNull() & (logit >= math.log(SURE / (1 - SURE))) & (F.col("shape") >= 0)
    scored = found.withColumn("taken", F.coalesce(F.col("base") | sure, F.lit(False)))
    order = W.partitionBy("row").orderBy(F.col("start").asc_nulls_first(), F.col("base").desc_nulls_last(), "kind", "end", "shape")
    past, ahead = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(1, W.unboundedFollowing)
    reach = F.coalesce(F.max(F.when(F.col("taken"), F.col("end"))).over(past), F.lit(0))
    following = F.min(F.when(F.col("base"), F.col("start"))).over(ahead)
    scored = scored.withColumn("reach", reach).withColumn("following", following)
    free = (F.col("start") >= F.col("reach")) & (F.coalesce(F.col("end") <= F.col("following"), F.lit(True)))
    scored = scored.withColumn("taken", F.col("taken") & (F.col("base") | free))
    # Candidates that lost to another span must not cut the text either.
    scored = scored.withColumn("reach", F.coalesce(F.max(F.when(F.col("taken"), F.col("end"))).over(past), F.lit(0)))
    listed = F.struct("kind", "start", "end", "base")
    cut = F.struct("kind", F.greatest("start", "reach").alias("start"), "end")
    grouped = scored.groupBy("row").agg(
        F.max("id").alias("id"),
        F.array_sort(F.collect_list(F.when(F.col("taken"), listed))).alias("spans"),
        F.collect_list(F.when(F.col("taken") & (F.col("end") > F.col("reach")), cut)).alias("cuts"),
        F.first("row_data", ignorenulls=True).alias("row_data"),
    )
    by_place = F.array_sort("cuts", lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0))
    return clean.unionByName(grouped.select("id", "spans", by_place.alias("cuts"), F.col("row_data.row_data").alias("row_data")))


def redacted(text: Column, cuts: Column) -> Column:
    """The text with every cut replaced by its kind in brackets."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    parts = F.transform(
        cuts,
        lambda c, i: F.concat(
            F.substring(text, F.when(i > 0, F.get(cuts, i - 1)["end"]).otherwise(0) + 1, c["start"] - F.when(i > 0, F.get(cuts, i - 1)["end"]).otherwise(0)),
            F.get(names, c["kind"]),
        ),
    )
    last = F.when(F.size(cuts) > 0, F.get(cuts, F.size(cuts) - 1)["end"]).otherwise(0)
    return F.concat(F.array_join(parts, ""), F.substring(text, last + 1, F.char_length(text)))
