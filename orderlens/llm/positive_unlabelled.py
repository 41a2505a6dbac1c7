"""Quality scores from positive-unlabelled learning.

Features of a text are shares of character classes, repetition of words and lines,
and lengths, cut into bins by quantiles. A logistic model over the bins is fitted
by minimising the non-negative unbiased risk of Kiryo et al. (2017): trusted
positives on one side, all unlabelled text on the other, weighted by the share of
positives in unlabelled text. That share is estimated over all unlabelled rows, as
the smallest ratio between how much of the unlabelled and of the positive scores
lies above a cut, for models that tell the two sides apart, each scoring the half
of the rows that it has not seen. By the rule of Bayes, that share times the ratio
of the two sides' densities at a score gives the probability that is returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import saved
from orderlens.llm.words import slices, word_lists

#: Trusted rows that models are fitted on at most, unless the caller says so, and unlabelled rows that they start from.
FIT_ROWS = 30_000
BINS = 16
STEPS = 400
RATE = 0.05
#: Steps over all unlabelled rows after those over the rows it starts from, and their rates.
WHOLE_RATES = (0.02, 0.02, 0.01, 0.01, 0.005, 0.005)
#: Weight of the squared weights in the risk, over the number of rows fitted on.
DECAY = 3.0
#: Cuts of the scores between which the share of positives is estimated.
CUTS = 200
#: Rows that each step of the calibration counts beyond the real ones.
SMOOTH = 0.02
#: Least share of positives above a cut that counts.
LEAST_ABOVE = 0.5

CLASSES = ("upper", "lower", "digit", "stop", "comma", "mark", "pipe", "sign", "bracket", "line", "space", "high")
MEMBERS = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"abcdefghijklmnopqrstuvwxyz",
    b"0123456789",
    b".",
    b",;:",
    b"!?",
    b"|",
    b"#$%&*+=@^~\\/_",
    b"<>[](){}",
    b"\n\r",
    b" \t",
    bytes(range(128, 256)),
)
FEATURES = len(CLASSES) + 9


def class_of_byte() -> np.ndarray:
    table = np.full(256, len(CLASSES), np.uint8)
    for k, members in enumerate(MEMBERS):
        table[list(members)] = k
    return table


def distinct_per_owner(owner: np.ndarray, code: np.ndarray, n: int) -> np.ndarray:
    """How many different codes each owner has."""
    if not len(owner):
        return np.zeros(n)
    pairs = np.unique(owner.astype(np.int64) * (int(code.max()) + 1) + code)
    return np.bincount(pairs // (int(code.max()) + 1), minlength=n).astype(float)


def split_codes(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, code) of the non-empty members of each list."""
    owner, flat = pc.list_parent_indices(lists), pc.list_flatten(lists)
    real = pc.greater(pc.binary_length(flat), 0)
    return np.asarray(owner.filter(real)), np.asarray(flat.filter(real).dictionary_encode().indices)


def features(texts: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` numbers for each text."""
    table, out = class_of_byte(), []
    for _, part in slices(texts):
        part = pc.fill_null(part, "").cast(pa.large_string())
        n = len(part)
        size = np.asarray(pc.binary_length(part), np.int64)
        owner = np.repeat(np.arange(n), size)
        data = np.frombuffer(b"".join(part.cast(pa.large_binary()).to_pylist()), np.uint8)
        width = len(CLASSES) + 1
        counts = np.bincount(owner * width + table[data], minlength=n * width).reshape(n, width)[:, : len(CLASSES)]
        total = np.maximum(size, 1)
        word_owner, flat = word_lists(part, lower=False)
        word, word_size = np.asarray(flat.dictionary_encode().indices), np.asarray(pc.binary_length(flat))
        words = np.bincount(word_owner, minlength=n)
        some = np.maximum(words, 1)
        again = (word[1:] == word[:-1]) & (word_owner[1:] == word_owner[:-1])
        line_owner, line = split_codes(pc.split_pattern(part, "\n"))
        lines = np.maximum(np.bincount(line_owner, minlength=n), 1)
        columns = [
            *(counts / total[:, None]).T,
            np.log1p(size),
            np.log1p(words),
            np.bincount(word_owner[1:][again], minlength=n) / some,
            distinct_per_owner(word_owner, word, n) / some,
            np.bincount(word_owner, word_size, n) / some,
            np.bincount(word_owner, word_size > 12, n) / some,
            distinct_per_owner(line_owner, line, n) / lines,
            np.log1p(words / lines),
            some / (1 + counts[:, CLASSES.index("stop")] + counts[:, CLASSES.index("mark")]),
        ]
        out.append(np.column_stack(columns))
    return np.concatenate(out) if out else np.empty((0, FEATURES))


def feature_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, x) with the features of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(1)).astype(np.float32)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], names=["id", "x"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, x array<float>")


class BinnedLogistic:
    """A logistic model over one-hot bins of the features."""

    def __init__(self, sample: np.ndarray):
        marks = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(column, marks)) for column in sample.T]
        self.first = np.cumsum([0] + [len(e) + 1 for e in self.edges])
        self.weights = np.zeros(self.first[-1] + 1)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([first + np.searchsorted(edges, column, side="right") for first, edges, column in zip(self.first, self.edges, x.T)])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.cells(x)].sum(axis=1) + self.weights[-1] if len(x) else np.empty(0)

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> None:
        """Minimise the non-negative risk; without a prior, tell the two samples apart."""
        size, decay = len(self.weights), DECAY / max(1, len(positive) + len(unlabelled))
        groups = [(self.cells(x), 1 / max(len(x), 1)) for x in (positive, unlabelled)]
        moment, square = np.zeros(size), np.zeros(size)
        for step in range(1, STEPS + 1):
            parts = []
            for cells, share in groups:
                p = 1 / (1 + np.exp(-(self.weights[cells].sum(axis=1) + self.weights[-1])))
                parts.append((cells, share, p))

            def gradient(part: tuple, to: int) -> np.ndarray:
                cells, share, p = part
                error = (p - to) * share
                out = np.bincount(cells.ravel(), np.repeat(error, cells.shape[1]), size)
                out[-1] = error.sum()
                return out

            def loss(part: tuple, to: int) -> float:
                _, share, p = part
                return float(-np.log(np.maximum(p if to else 1 - p, 1e-12)).sum() * share)

            if prior is None:
                g = gradient(parts[0], 1) + gradient(parts[1], 0)
            elif loss(parts[1], 0) - prior * loss(parts[0], 0) < 0:
                g = prior * gradient(parts[0], 0) - gradient(parts[1], 0)
            else:
                g = prior * (gradient(parts[0], 1) - gradient(parts[0], 0)) + gradient(parts[1], 0)
            g += decay * self.weights
            moment, square = 0.9 * moment + 0.1 * g, 0.999 * square + 0.001 * g * g
            self.weights -= RATE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)


def whole_sums(table: DataFrame, model: BinnedLogistic) -> tuple[np.ndarray, float, int]:
    """(gradient, loss, rows) of taking all rows of a feature table for negative, as sums over them."""
    size = len(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 2)
        for batch in batches:
            x = np.asarray(pc.list_flatten(batch.column(0)), np.float32).reshape(-1, FEATURES).astype(float)
            cells = model.cells(x)
            p = 1 / (1 + np.exp(-(model.weights[cells].sum(axis=1) + model.weights[-1])))
            total[:size] += np.bincount(cells.ravel(), np.repeat(p, cells.shape[1]), size)
            total[size - 1] += p.sum()
            total[size] -= np.log(np.maximum(1 - p, 1e-12)).sum()
            total[size + 1] += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 2)), pa.array(total)], names=["at", "x"])

    total = np.zeros(size + 2)
    for row in table.select("x").mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect():
        total[row["at"]] = row["x"]
    return total[:size], float(total[size]), int(total[size + 1])


def fit_whole(model: BinnedLogistic, positive: np.ndarray, unlabelled: DataFrame, prior: float) -> None:
    """Go on minimising the non-negative risk, with the unlabelled side's part of it from all its rows."""
    size = len(model.weights)
    cells, share = model.cells(positive), 1 / max(len(positive), 1)
    moment, square = np.zeros(size), np.zeros(size)

    for step, rate in enumerate(WHOLE_RATES, start=1):
        g, loss, rows = whole_sums(unlabelled, model)
        g, loss = g / max(rows, 1), loss / max(rows, 1)
        p = 1 / (1 + np.exp(-(model.weights[cells].sum(axis=1) + model.weights[-1])))
        # Taking the positives for negative, and the difference that taking them for positive makes.
        negative = np.bincount(cells.ravel(), np.repeat(p * share, cells.shape[1]), size)
        negative[-1] = p.sum() * share
        ones = np.bincount(cells.ravel(), minlength=size) * share
        ones[-1] = len(positive) * share
        if loss + prior * np.log(np.maximum(1 - p, 1e-12)).sum() * share < 0:
            g = prior * negative - g
        else:
            g = g - prior * ones
        g += DECAY / max(1, len(positive) + rows) * model.weights
        moment, square = 0.9 * moment + 0.1 * g, 0.999 * square + 0.001 * g * g
        model.weights -= rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)


def half(id_col: str = "id") -> Column:
    """0 or 1 by a hash of the id; rows without one are in half 0."""
    return F.pmod(F.xxhash64(id_col, F.lit("half")), F.lit(2)).cast("int")


def scores(table: DataFrame, models: list[BinnedLogistic], chance: np.ndarray | None = None) -> DataFrame:
    """(id, score) of every row of a feature table, by its half's model where there are two.

    With a calibration the score is its probability, and to a small part the score
    itself, so that rows in one step keep their order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(pc.list_flatten(batch.column(1)), np.float32).reshape(-1, FEATURES).astype(float)
            logits = np.array([m.logit(x) for m in models])
            score = 1 / (1 + np.exp(-logits[np.asarray(batch.column(2)) % len(models), np.arange(len(x))]))
            if chance is not None:
                score = 0.98 * np.interp(score * CUTS, np.arange(CUTS + 1) + 0.5, chance) + 0.02 * score
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["id", "score"])

    return table.select("id", "x", half().alias("half")).mapInArrow(run, "id long, score double")


def sample(table: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``rows`` feature rows, the same ones whatever the partitioning, and their halves.

    Rows are taken by falling place of a hash of the id; a cut at the place that about
    ``rows`` rows lie below keeps what tasks send to the driver to that number.
    """
    place = F.xxhash64("id")
    share = min(1.0, 1.2 * rows / max(1, table.count()) + 1e-9)
    cut = int(-(2**63) + share * (2**64 - 1))
    near = table.select("id", "x", half().alias("half"), place.alias("place"))
    near = near.filter(F.col("place") <= F.lit(min(cut, 2**63 - 1)))
    picked = near.orderBy("place", "id").limit(rows).collect()
    return np.array([r["x"] for r in picked], float).reshape(-1, FEATURES), np.array([r["half"] for r in picked], int)


def histogram(side: DataFrame) -> np.ndarray:
    """How many rows have a score in each of ``CUTS`` steps, from all rows."""
    counts = np.zeros(CUTS + 1)
    for row in side.groupBy(F.floor(F.col("score") * CUTS).cast("int").alias("cut")).count().collect():
        counts[row["cut"]] = row["count"]
    return counts


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among unlabelled rows, from the histograms of both sides.

    The least ratio of the shares above a cut, with one standard error of the numerator.
    """
    p, u = (h[::-1].cumsum()[::-1] / max(h.sum(), 1) for h in (positive, unlabelled))
    enough = p >= LEAST_ABOVE
    slack = 0.5 / np.sqrt(max(unlabelled.sum(), 1))
    return float(np.clip(((u[enough] + slack) / p[enough]).min() if enough.any() else 0.5, 0.01, 0.99))


def calibration(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """The probability of the positive class in each step of the score, never falling."""
    expected = prior * positive / max(positive.sum(), 1) * unlabelled.sum()
    pools: list[list[float]] = []
    for good, all_rows in zip(expected + SMOOTH * prior, unlabelled + SMOOTH):
        pools.append([good, all_rows, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.concatenate([[min(1.0, good / rows)] * int(steps) for good, rows, steps in pools])


def told_apart(good: np.ndarray, good_half: np.ndarray, other: np.ndarray, other_half: np.ndarray) -> list[BinnedLogistic]:
    """Models that tell the two sides apart; the model for a half is fitted on the other one."""
    models = []
    for h in (0, 1):
        a, b = good[good_half != h], other[other_half != h]
        a, b = (a if len(a) else good), (b if len(b) else other)
        model = BinnedLogistic(np.concatenate((a, b)))
        model.fit(a, b, None)
        models.append(model)
    return models


def quality_scores(
    docs: DataFrame,
    positives: DataFrame,
    labelled: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    fit_on: Column | None = None,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """(id, score) for every row of docs: the probability that its text is good.

    ``positives`` has the ids of trusted good documents, ``labelled`` those of all
    documents somebody judged (default: the positives); the rest of docs is the
    unlabelled side, and all of docs where nothing is left. ``fit_on``, a condition on
    column id, keeps rows out of fitting altogether. Of the trusted rows at most ``fit_rows`` are
    fitted on, taken by a hash of the id. Bin edges and first weights come from these and as
    many unlabelled rows; then the risk over all unlabelled rows is minimised, and the class
    prior and the calibration come from all rows. Null and empty texts are scored as
    texts without characters; rows that repeat an id or have none are scored one by
    one. Without a trusted row or without any to fit on, every score is 0.5.
    """
    table = saved(feature_table(docs, id_col, text_col))
    usable = table.filter("id is not null")
    usable = usable.filter(fit_on) if fit_on is not None else usable
    ids = positives.select(F.col(positives.columns[0]).cast("long").alias("id")).distinct()
    judged = ids if labelled is None else labelled.select(F.col(labelled.columns[0]).cast("long").alias("id")).union(ids).distinct()
    positive = usable.join(ids, "id", "left_semi")
    unlabelled = saved(usable.join(judged, "id", "left_anti"))
    if unlabelled.isEmpty():
        unlabelled = usable
    (good, good_half), (other, other_half) = sample(positive, fit_rows), sample(unlabelled, FIT_ROWS)
    if not len(good) or not len(other):
        return table.select("id", F.lit(0.5).alias("score"))
    models = told_apart(good, good_half, other, other_half)
    prior = class_prior(histogram(scores(positive, models)), histogram(scores(unlabelled, models)))
    model = BinnedLogistic(np.concatenate((good, other)))
    model.fit(good, other, prior)
    fit_whole(model, good, unlabelled, prior)
    chance = calibration(histogram(scores(positive, [model])), histogram(scores(unlabelled, [model])), prior)
    return scores(table, [model], chance)
