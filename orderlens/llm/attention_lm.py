"""Language-model scores from a small causal self-attention model over subword ids.

Documents are read once into blocks: a block holds its documents' words as codes into its own
vocabulary, and every word of that vocabulary with its subword ids, so a word is encoded once a
block. Counts of words and of subwords come from all blocks: blocks deal their vocabularies by a
hash into buckets of bounded size, and a bucket adds up the words of all blocks. The model predicts the class of the
next subword from the window before it, and from the same state the subword inside its class, so that each subword
that training holds has weights of its own, as input and as output. Training is numpy inside tasks: each task walks over the training windows of its blocks
from the same weights, and the weights of all tasks are averaged after every round. The rounds
share out the windows, so that each window of each training document is walked over once. Scoring
cuts documents into overlapping windows, whose last places are scored, so each subword is scored
once, with masked attention over batches of windows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm.common import remove_dir, run_dir, saved, stored, with_short_batches
from orderlens.llm.packing_ga import WordIds
from orderlens.llm.words import bytes_of, slices, word_lists

#: Bytes of text in a block, which a slice of ``SLICE_BYTES`` may exceed, and longer texts.
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 2 << 20
#: Words of vocabularies in a bucket, about.
BUCKET_WORDS = 1 << 19
#: Subwords that a window scores, and how many before them it sees as well.
FRESH, BEFORE = 24, 8
WINDOW = BEFORE + FRESH
#: Width of the model, its heads, and its inner layer.
WIDTH, HEADS, INNER = 16, 2, 32
#: Subwords with a class of their own among the outputs, bands of the others, and the most subwords in a band.
OWN_CLASSES, BANDS, BAND_ROWS = 28, 20, 512
#: Windows in a step of training, and in a batch of scoring; places whose subwords are scored inside their bands at once.
STEP_WINDOWS, BATCH_WINDOWS, BAND_PLACES = 96, 96, 1 << 15
#: Rounds of training, and steps of the weights in them.
ROUNDS = 3
RATES = (0.02, 0.01, 0.004)
#: Weights that tasks hand on at once.
PIECE = 1 << 13
#: What is added to each count.
ADDED = 0.1

#: All that is binary is packed integers, but for letters: the words one after another, whose lengths are beside them.
BLOCK = (
    "block long, ids array<long>, trains array<boolean>, words array<binary>, n_words long, letters binary, lengths binary, trained binary, "
    "bounds binary, codes binary, subs binary, sub_bounds binary, met binary, met_n binary"
)
#: The words of a block in a bucket, one after another, their lengths and places in the block's vocabulary.
DEALT = "bucket int, block long, letters binary, lengths binary, places binary, trained binary"
#: Places of words with their counts over all blocks; a bucket's first row has the sum and the number of its counts.
KNOWN = "block long, places binary, c binary, total long, distinct long"
SCORES = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def learnt_from(number: int | None, folds: int) -> bool:
    """Whether the model may learn from a document; one without an id it may not."""
    return number is not None and zlib.crc32(str(number).encode()) % folds != 0


def numbered(number: int | str | None) -> int | None:
    """The id as a number; a text that is none counts as no id."""
    return number if not isinstance(number, str) else int(number) if number.strip().removeprefix("-").isdecimal() else None


def squeezed(numbers: np.ndarray, kind: str = "<i4") -> bytes:
    return zstandard.ZstdCompressor().compress(numbers.astype(kind).tobytes())


def ints(batch: pa.RecordBatch | pa.Table, name: str, row: int = 0, kind: str = "<i4") -> np.ndarray:
    """The packed integers of a row."""
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(batch.column(name)[row].as_py()), kind)


def block_rows(tokenizer_path: str, folds: int):
    """A task's function from (id, text) to ``BLOCK``."""

    def block(number: int, parts: list[tuple], known: WordIds) -> pa.RecordBatch:
        ids, owners, codes, names = ([part[k] for part in parts] for k in range(4))
        # Each slice has codes of its own; the block's are those of all their words.
        coded = pa.concat_arrays(names).dictionary_encode()
        own, words = np.asarray(coded.indices), coded.dictionary.cast(pa.binary())
        first = np.cumsum([0, *map(len, names)])
        codes = np.concatenate([own[at : at + len(n)][c] for at, n, c in zip(first, names, codes)])
        rows = np.cumsum([0, *map(len, ids)])
        owner = np.concatenate([at + o for at, o in zip(rows, owners)])
        ids = [x for part in ids for x in part]
        trains = np.array([learnt_from(x, folds) for x in ids], bool)
        sub_bounds, subs = known.encode(words)
        trained = np.bincount(codes[trains[owner]], minlength=len(words))
        uses = np.bincount(subs, np.repeat(trained, np.diff(sub_bounds)))
        met = np.flatnonzero(uses)
        offsets, letters = bytes_of(words)
        row = {
            "block": [number],
            "ids": [ids],
            "trains": [trains],
            "words": pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
            "n_words": [len(words)],
            "letters": [letters.tobytes()],
            "lengths": [squeezed(np.diff(offsets))],
            "trained": [squeezed(trained)],
            "bounds": [squeezed(np.searchsorted(owner, np.arange(len(ids) + 1)))],
            "codes": [squeezed(codes)],
            "subs": [squeezed(subs)],
            "sub_bounds": [squeezed(sub_bounds)],
            "met": [squeezed(met)],
            "met_n": [squeezed(uses[met], "<i8")],
        }
        return pa.RecordBatch.from_pydict(row, schema=BLOCK_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, parts, held = WordIds(tokenizer_path), [], 0
        # Blocks are numbered within their task, and kept under the numbers that the task writes.
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, part in slices(batch.column(1), SLICE_BYTES):
                owner, flat = word_lists(part, lower=True)
                coded = flat.dictionary_encode()
                ids = [numbered(x) for x in batch.column(0).slice(first, len(part)).to_pylist()]
                parts.append((ids, owner.astype(np.int32), np.array(coded.indices, np.int32), coded.dictionary))
                held += pc.sum(pc.binary_length(part)).as_py() or 0
                if held >= BLOCK_BYTES:
                    yield block(number, parts, known)
                    number, parts, held = number + 1, [], 0
        if parts:
            yield block(number, parts, known)

    return run


BLOCK_SCHEMA = pa.schema(
    [("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("trains", pa.list_(pa.bool_()))]
    + [("words", pa.list_(pa.binary())), ("n_words", pa.int64())]
    + [(c, pa.binary()) for c in ("letters", "lengths", "trained", "bounds", "codes", "subs", "sub_bounds", "met", "met_n")]
)


def spread(values: np.ndarray, bounds: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, flat): the values of each code, one after another; those of code c lie between its bounds."""
    sizes = np.diff(bounds)[codes]
    ends = np.cumsum(sizes, dtype=np.int32)
    at = np.repeat((bounds[1:][codes] - ends).astype(np.int32), sizes)
    at += np.arange(len(at), dtype=np.int32)
    return sizes, values[at]


def subword_counts(blocks: DataFrame, size: int, end_id: int) -> np.ndarray:
    """How often each subword, and the end, occurs in the training documents of all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for row in range(batch.num_rows):
                total[ints(batch, "met", row)] += ints(batch, "met_n", row, "<i8")
                total[end_id] += np.asarray(batch.column("trains")[row].values).sum()
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found].astype(np.int64))], names=["sub", "n"])

    # One row for each subword of the tokenizer at most.
    sums = blocks.select("met", "met_n", "trains").mapInArrow(run, "sub long, n long").groupBy("sub").agg(F.sum("n").alias("n"))
    counts = np.zeros(size)
    for row in with_short_batches(blocks.sparkSession, sums.collect):
        counts[row["sub"]] = row["n"]
    return counts


def words_of(letters: bytes, lengths: np.ndarray) -> pa.Array:
    """The words of these lengths, which lie one after another."""
    offsets = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])


def word_counts(blocks: DataFrame) -> DataFrame:
    """``KNOWN`` for the words that occur in training documents, with counts over all blocks."""
    words = blocks.agg(F.sum("n_words")).first()[0] or 0
    buckets = -(-words // BUCKET_WORDS) or 1

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                words = words_of(batch.column("letters")[row].as_py(), ints(batch, "lengths", row))
                hashes = np.fromiter(map(zlib.crc32, words.to_numpy(zero_copy_only=False).tolist()), np.uint32, len(words))
                bucket = (hashes % buckets).astype(np.min_scalar_type(buckets))
                order = np.argsort(bucket, kind="stable")
                offsets, data = bytes_of(words.take(pa.array(order)))
                trained, lengths = ints(batch, "trained", row)[order], np.diff(offsets)
                found, first = np.unique(bucket[order], return_index=True)
                parts = list(zip(first.tolist(), [*first[1:].tolist(), len(order)]))
                columns = [
                    pa.array(found, pa.int32()),
                    pa.array(np.repeat(batch.column("block")[row].as_py(), len(found)), pa.int64()),
                    pa.array([data[offsets[a] : offsets[b]].tobytes() for a, b in parts], pa.binary()),
                    *(pa.array([squeezed(x[a:b]) for a, b in parts], pa.binary()) for x in (lengths, order, trained)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "letters", "lengths", "places", "trained"])

    def added(bucket: pa.Table) -> pa.Table:
        lengths, trained = ([ints(bucket, name, row) for row in range(bucket.num_rows)] for name in ("lengths", "trained"))
        stops = np.cumsum([len(n) for n in lengths])
        words = words_of(b"".join(bucket["letters"].to_pylist()), np.concatenate(lengths))
        codes = np.asarray(words.dictionary_encode().indices)
        total = np.bincount(codes, np.concatenate(trained)).astype(np.int64)
        rows = {"block": bucket["block"], "places": [], "c": [], "total": [int(total.sum())], "distinct": [int((total > 0).sum())]}
        for row, part in enumerate(np.split(total[codes], stops[:-1])):
            rows["places"].append(squeezed(ints(bucket, "places", row)[part > 0]))
            rows["c"].append(squeezed(part[part > 0], "<i8"))
        for name in ("total", "distinct"):
            rows[name] += [0] * (bucket.num_rows - 1)
        return pa.table(rows)

    return blocks.select("block", "letters", "lengths", "trained").mapInArrow(dealt, DEALT).groupBy("bucket").applyInArrow(added, KNOWN)


class Classes:
    """Classes of subwords by their counts, and each subword's share of its class.

    The most frequent subwords have a class of their own; the others lie in bands of like
    total count and bounded size, those that end words apart from those inside. Inside a band, subwords are told apart
    by weights of their own, in the order of ``member`` (from 1; 0 for those without). Subwords that no training document holds are
    one more class, all of whose subwords are alike: there is nothing to learn of them. Every subword has a row
    of its own among the inputs.
    """

    def __init__(self, counts: np.ndarray, ends: np.ndarray):
        order = np.argsort(-counts, kind="stable")
        own, rest = order[:OWN_CLASSES], order[OWN_CLASSES:]
        met, unmet = rest[counts[rest] > 0], rest[counts[rest] <= 0]
        met = met[np.argsort(ends[met], kind="stable")]
        mass = np.cumsum(counts[met] + ADDED)
        band = np.minimum(BANDS - 1, mass / mass.max(initial=1) * BANDS).astype(np.int64)
        within = np.arange(len(met)) - np.searchsorted(band, band)
        _, band = np.unique(band * len(met) + within // BAND_ROWS, return_inverse=True)
        bands = int(band.max(initial=-1)) + 1
        #: Members of a band lie between its bounds.
        self.bounds = np.searchsorted(band, np.arange(bands + 1))
        self.of = np.empty(len(counts), np.int32)
        self.of[own] = np.arange(len(own))
        self.of[met] = len(own) + band
        self.of[unmet] = len(own) + bands
        self.n = len(own) + bands + (len(unmet) > 0)
        self.member = np.zeros(len(counts), np.min_scalar_type(len(met)))
        self.member[met] = np.arange(1, len(met) + 1)
        total = np.bincount(self.of, counts + ADDED, self.n)
        self.log_share = np.log((counts + ADDED) / total[self.of])
        self.log_member = self.log_share[met].astype(np.float32)
        self.log_prior = np.log(np.maximum(total, ADDED) / total.sum()).astype(np.float32)
        # Frequent subwords come first, so that those of training lie together.
        self.row = np.empty(len(counts), np.int32)
        self.row[order] = np.arange(len(order))
        self.rows = len(counts)


#: Weights with a row for each subword, of which a step changes those that it meets.
TABLES = ("token", "own")


def first_weights(classes: Classes, seed: int = 5) -> dict[str, np.ndarray]:
    """Small random weights whose outputs are the shares of the corpus of the classes, and of the subwords inside them.

    Rows of ``own`` are those of the bands' members, a bias behind them.
    """
    rng = np.random.default_rng(seed)

    def random(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * 0.3 / np.sqrt(WIDTH)).astype(np.float32)

    token = random(classes.rows, WIDTH) * 2
    return {
        "place": random(WINDOW, WIDTH),
        "query": random(WIDTH, WIDTH),
        "key": random(WIDTH, WIDTH),
        "value": random(WIDTH, WIDTH),
        "joined": random(WIDTH, WIDTH),
        "up": random(WIDTH, INNER),
        "up_bias": np.zeros(INNER, np.float32),
        "down": random(INNER, WIDTH),
        "out": random(WIDTH, classes.n) * 0.1,
        "out_bias": classes.log_prior.copy(),
        "token": token,
        "own": np.concatenate((np.zeros((len(classes.log_member), WIDTH), np.float32), classes.log_member[:, None]), axis=1),
    }


#: 1 where a scored place (row) may look: at itself and what is before it in the window. A row for each head.
SEEN = np.repeat(np.tri(FRESH, WINDOW, BEFORE, dtype=np.float32), HEADS, axis=0)
#: Scores of attention above this count as this, so that their powers stay finite.
HIGHEST = 30
SHARP = np.float32((WIDTH // HEADS) ** -0.5)
#: Sums of powers up to this, and from its inverse on, are as good as those of powers divided by the largest.
PLAIN = 1e25


#: The columns of each head.
OF_HEADS = [slice(h * WIDTH // HEADS, (h + 1) * WIDTH // HEADS) for h in range(HEADS)]


def products(w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(asked, told): the products query key' and value joined of the heads, beside and below one another.

    Attention needs no others: scores are (x asked) x', and what is seen is (share x) told.
    """
    asked = np.concatenate([w["query"][:, h] @ w["key"][:, h].T for h in OF_HEADS], axis=1)
    asked *= SHARP
    return asked, np.concatenate([w["value"][:, h] @ w["joined"][h] for h in OF_HEADS])


def summed(x: np.ndarray) -> np.ndarray:
    """Sums over the last axis, kept as one of length 1."""
    return x @ np.ones((x.shape[-1], 1), x.dtype)


def wide(column: np.ndarray) -> np.ndarray:
    """The column ``WIDTH`` times: products of whole matrices take less time than those with a column."""
    return np.repeat(column, WIDTH).reshape(-1, WIDTH)


def attended(w: dict[str, np.ndarray], rows: np.ndarray, there: np.ndarray, pair: tuple[np.ndarray, np.ndarray] | None = None) -> dict[str, np.ndarray]:
    """The model's state at the scored places of a batch of windows; ``pair`` are the ``products``.

    No place sees a later one, and none sees those that are not ``there``.
    """
    asked, told = pair or products(w)
    b = len(rows)
    x = w["token"].take(rows, axis=0)
    x += w["place"]
    own = x[:, BEFORE:].reshape(-1, WIDTH)
    q = (own @ asked).reshape(b, -1, WIDTH)
    weight = q @ x.transpose(0, 2, 1)
    if not weight.max(initial=0) <= HIGHEST:
        np.minimum(weight, HIGHEST, out=weight)
    np.exp(weight, out=weight)
    weight *= SEEN
    if not there.all():
        window, place = np.nonzero(~there)
        weight[window, :, place] = 0
    total = summed(weight.reshape(-1, WINDOW)) + np.float32(1e-9)
    mixed = (weight @ x).reshape(-1, WIDTH)
    mixed /= wide(total)
    y = mixed.reshape(len(own), -1) @ told
    y += own
    inner = y @ w["up"]
    inner += w["up_bias"]
    on = inner > 0
    inner *= on
    z = inner @ w["down"]
    z += y
    return {"x": x, "own": own, "q": q, "weight": weight, "total": total, "mixed": mixed, "y": y, "inner": inner, "on": on, "z": z.reshape(b, FRESH, WIDTH)}


def logits_of(w: dict[str, np.ndarray], z: np.ndarray) -> np.ndarray:
    logits = z @ w["out"]
    logits += w["out_bias"]
    return logits


def powers(w: dict[str, np.ndarray], z: np.ndarray, logits: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Turns the logits of z into their powers, each row's divided by that of its largest where they need it; (sums, these largest, if so)."""
    with np.errstate(over="ignore"):
        np.exp(logits, out=logits)
        total = summed(logits)
    if total.max(initial=1) < PLAIN and total.min(initial=1) > 1 / PLAIN:
        return total, None
    logits[...] = logits_of(w, z)
    top = logits.max(axis=1, keepdims=True)
    logits -= top
    np.exp(logits, out=logits)
    return summed(logits), top


def log_classes(w: dict[str, np.ndarray], z: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural logarithms of the probabilities of the target classes for rows of states."""
    logits = logits_of(w, z)
    hit = logits.reshape(-1)[np.arange(0, logits.size, logits.shape[1]) + targets]
    total, top = powers(w, z, logits)
    return hit - (0 if top is None else top[:, 0]) - np.log(total[:, 0])


def in_bands(members: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
    """(order, parts): places in the order of their members; parts (a, b, lo, hi) say that those from lo to hi have members of the band from a to b."""
    order = np.argsort(members, kind="stable")
    cuts = np.searchsorted(members[order], bounds + 1).tolist()
    bounds = bounds.tolist()
    return order, [part for part in zip(bounds, bounds[1:], cuts, cuts[1:]) if part[2] < part[3]]


def with_ones(z: np.ndarray) -> np.ndarray:
    """The rows of z, each with a 1 behind it for the bias."""
    wider = np.ones((len(z), WIDTH + 1), z.dtype)
    wider[:, :WIDTH] = z
    return wider


def log_members(own: np.ndarray, z: np.ndarray, members: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Natural logarithms of the probabilities of the target subwords inside their bands, 0 for those without a band."""
    order, parts = in_bands(members, bounds)
    z, target, logs = with_ones(z[order]), members[order].astype(np.intp) - 1, np.zeros(len(z))
    for a, b, lo, hi in parts:
        p = z[lo:hi] @ own[a:b].T
        p -= p.max(axis=1, keepdims=True)
        hit = p.reshape(-1)[np.arange(0, p.size, b - a) + target[lo:hi] - a]
        np.exp(p, out=p)
        logs[order[lo:hi]] = hit - np.log(summed(p)[:, 0])
    return logs


def member_gradients(own: np.ndarray, z: np.ndarray, members: np.ndarray, bounds: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(dz, rows, of these rows of ``own``) of the loss inside the bands, each place with this share of it."""
    order, parts = in_bands(members, bounds)
    z, target = with_ones(z[order]), members[order].astype(np.intp) - 1
    dz, found = np.zeros((len(z), WIDTH), z.dtype), [own[:0]]
    for a, b, lo, hi in parts:
        weights, states = own[a:b], z[lo:hi]
        p = states @ weights.T
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p *= np.asarray(share, p.dtype) / summed(p)
        p.reshape(-1)[np.arange(0, p.size, b - a) + target[lo:hi] - a] -= share
        found.append(p.T @ states)
        dz[order[lo:hi]] = p @ weights[:, :WIDTH]
    rows = np.concatenate([np.arange(0), *[np.arange(a, b) for a, b, _, _ in parts]])
    return dz, rows, np.concatenate(found)


def gradients(
    w: dict[str, np.ndarray], rows: np.ndarray, there: np.ndarray, targets: np.ndarray, members: np.ndarray | None = None, bounds: np.ndarray | None = None
) -> dict[str, np.ndarray]:
    """Of the mean loss over the scored places that are there; ``targets`` are the classes at the scored places.

    With ``members`` at these places, and the ``bounds`` of their bands, the loss has the subwords inside the classes as well.
    """
    g, touched = changes(w, rows, there, targets, members, bounds)
    for name in TABLES:
        g[name] = np.zeros_like(w[name])
        at, found = touched[name]
        g[name][at] = found
    return g


def changes(
    w: dict[str, np.ndarray], rows: np.ndarray, there: np.ndarray, targets: np.ndarray, members: np.ndarray | None, bounds: np.ndarray | None
) -> tuple[dict[str, np.ndarray], dict[str, tuple[np.ndarray, np.ndarray]]]:
    """The ``gradients`` of weights that are no ``TABLES``, and for these (rows, gradients of them)."""
    asked, told = pair = products(w)
    s, b = attended(w, rows, there, pair), len(rows)
    x, own, q, mixed, y, z = s["x"], s["own"], s["q"], s["mixed"], s["y"], s["z"].reshape(-1, WIDTH)
    counted = there[:, BEFORE:].ravel()
    d = logits_of(w, z)
    total, _ = powers(w, z, d)
    share = 1 / max(1, np.count_nonzero(counted))
    part = (counted * share).astype(d.dtype)
    d *= part[:, None] / total
    d.reshape(-1)[np.arange(0, d.size, d.shape[1]) + targets.ravel()] -= part
    g = {"out": z.T @ d, "out_bias": np.ones(len(d), d.dtype) @ d}
    dz = d @ w["out"].T
    touched = {"own": (np.arange(0), w["own"][:0])}
    if members is not None:
        inside, *touched["own"] = member_gradients(w["own"], z, members.ravel(), bounds, share)
        dz += inside
    g["down"] = s["inner"].T @ dz
    d_inner = dz @ w["down"].T
    d_inner *= s["on"]
    g["up"], g["up_bias"] = y.T @ d_inner, np.ones(len(d), d.dtype) @ d_inner
    dy = d_inner @ w["up"].T
    dy += dz
    d_told = mixed.reshape(len(own), -1).T @ dy
    d_mixed = (dy @ told.T).reshape(-1, WIDTH)
    within = summed(d_mixed * mixed).reshape(b, -1, 1)
    # Two products over the same places as one: what they take lies below one another.
    both = np.empty((b, 2 * HEADS * FRESH, WINDOW), d.dtype)
    d_score, share = both[:, : HEADS * FRESH], both[:, HEADS * FRESH :]
    np.divide(s["weight"], s["total"].reshape(b, -1, 1), out=share)
    d_mixed = d_mixed.reshape(b, -1, WIDTH)
    np.matmul(d_mixed, x.transpose(0, 2, 1), out=d_score)
    d_score -= within
    d_score *= share
    dq = (d_score @ x).reshape(len(own), -1)
    dx = both.transpose(0, 2, 1) @ np.concatenate((q, d_mixed), axis=1)
    dy += dq @ asked.T
    dx[:, BEFORE:] += dy.reshape(b, FRESH, WIDTH)
    d_asked = own.T @ dq
    d_asked *= SHARP
    g |= {name: np.empty_like(w[name]) for name in ("query", "key", "value", "joined")}
    for k, h in enumerate(OF_HEADS):
        part = slice(k * WIDTH, (k + 1) * WIDTH)
        g["query"][:, h] = d_asked[:, part] @ w["key"][:, h]
        g["key"][:, h] = d_asked[:, part].T @ w["query"][:, h]
        g["value"][:, h] = d_told[part] @ w["joined"][h].T
        g["joined"][h] = w["value"][:, h].T @ d_told[part]
    g["place"] = dx.sum(axis=0)
    # Rows that the step meets, and their numbers among these.
    met = np.zeros(len(w["token"]), bool)
    met[rows] = True
    found = np.flatnonzero(met)
    number = np.empty(len(met), np.intp)
    number[found] = np.arange(0, found.size * WIDTH, WIDTH)
    cells = number[rows][..., None] + np.arange(WIDTH)
    touched["token"] = (found, np.bincount(cells.ravel(), dx.ravel(), found.size * WIDTH).reshape(-1, WIDTH))
    return g, touched


class Windows:
    """The windows over the documents of a block; each scores ``FRESH`` subwords and sees ``BEFORE`` more."""

    def __init__(self, sizes: np.ndarray):
        """``sizes`` counts each document's subwords, its end included."""
        self.sizes, self.first = sizes, np.cumsum(sizes) - sizes
        self.number = -(-sizes // FRESH)
        self.doc = np.repeat(np.arange(len(sizes)), self.number)
        self.turn = np.arange(len(self.doc)) - (np.cumsum(self.number) - self.number)[self.doc]

    def places(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, there) for the chosen windows: indices of subwords, and whether there is one."""
        doc = self.doc[chosen][:, None]
        at = self.turn[chosen][:, None] * FRESH + np.arange(-BEFORE, FRESH)
        there = (at >= 0) & (at < self.sizes[doc])
        return self.first[doc] + np.where(there, at, 0), there

    def laid_out(self, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
        """(at, view of each column): row ``at[k]`` of a view holds the values at the places of window k, 0 where there is none."""
        lengths = self.number * FRESH + BEFORE
        starts = np.cumsum(lengths) - lengths
        runs = np.stack((np.full_like(lengths, BEFORE), self.sizes, lengths - BEFORE - self.sizes), axis=1)
        there = np.repeat(np.tile([False, True, False], len(lengths)), runs.ravel())
        views = []
        for values in columns:
            room = np.zeros(max(WINDOW, len(there)), values.dtype)
            room[: len(there)][there] = values
            views.append(np.lib.stride_tricks.sliding_window_view(room, WINDOW))
        return starts[self.doc] + self.turn * FRESH, *views


def sequences_of(batch: pa.RecordBatch | pa.Table, end_id: int, row: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, flat): each document's subwords and its end."""
    bounds, subs, sub_bounds = (ints(batch, name, row) for name in ("bounds", "subs", "sub_bounds"))
    # The end is one more word, of one subword.
    codes = np.insert(ints(batch, "codes", row), bounds[1:], len(sub_bounds) - 1)
    sizes, flat = spread(np.append(subs, subs.dtype.type(end_id)), np.append(sub_bounds, np.int32(len(subs) + 1)), codes)
    ends = np.concatenate(([0], np.cumsum(sizes)))[bounds + np.arange(len(bounds))]
    return np.diff(ends), flat


def inputs_of(sizes: np.ndarray, flat: np.ndarray, start_id: int) -> np.ndarray:
    """What the model sees at each place: the subword before it, or the start."""
    before = np.empty_like(flat)
    before[1:] = flat[:-1]
    before[np.cumsum(sizes) - sizes] = start_id
    return before


def taken(windows: Windows, trains: np.ndarray, number: int) -> np.ndarray:
    """The windows of training documents that a round walks over: each is in one of the ``ROUNDS``."""
    return np.flatnonzero(trains[windows.doc] & ((windows.turn + windows.doc + number) % ROUNDS == 0))


def views(vector: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Parts of the vector in the order and with the names and shapes of ``like``."""
    ends = np.cumsum([v.size for v in like.values()])
    return {k: part.reshape(v.shape) for (k, v), part in zip(like.items(), np.split(vector, ends[:-1]))}


def trained(blocks: DataFrame, classes: Classes, weights: dict[str, np.ndarray], number: int, start_id: int, end_id: int) -> dict[str, np.ndarray]:
    """The weights after a round: tasks start from the same ones, theirs are averaged by their windows.

    All rounds together take every window of every training document once.
    """
    rate, start = RATES[min(number, len(RATES) - 1)], np.concatenate([v.ravel() for v in weights.values()])
    dense = sum(v.size for name, v in weights.items() if name not in TABLES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # All weights lie in one vector, of which w has views; those of tables come last.
        vector, moment, square = start.copy(), np.zeros_like(start), np.zeros_like(start)
        w, moments, squares = (views(v, weights) for v in (vector, moment, square))
        rng, steps, used = np.random.default_rng(number), 0, 0
        # Rows and classes in few bytes; a class of 0 marks places where nothing is.
        row_of = classes.row.astype(np.min_scalar_type(classes.rows))
        class_of = (classes.of + 1).astype(np.min_scalar_type(classes.n))
        for batch in batches:
            for row in range(batch.num_rows):
                sizes, flat = sequences_of(batch, end_id, row)
                windows = Windows(sizes)
                first, rows, targets, members = windows.laid_out(row_of[inputs_of(sizes, flat, start_id)], class_of[flat], classes.member[flat])
                order = rng.permutation(taken(windows, np.asarray(batch.column("trains")[row].values), number))
                for at in range(0, len(order), STEP_WINDOWS):
                    chosen = first[order[at : at + STEP_WINDOWS]]
                    aims = targets[chosen].astype(np.intp)
                    fresh = np.maximum(aims[:, BEFORE:] - 1, 0)
                    g, touched = changes(w, rows[chosen].astype(np.intp), aims > 0, fresh, members[chosen][:, BEFORE:], classes.bounds)
                    steps, used = steps + 1, used + len(chosen)
                    pace = np.float32(rate * (1 - 0.98**steps) ** 0.5 / (1 - 0.9**steps))
                    g = np.concatenate([g[name].ravel() for name in weights if name not in TABLES])
                    stepped(vector, moment, square, slice(0, dense), g, pace)
                    for name, (at_rows, found) in touched.items():
                        stepped(w[name], moments[name], squares[name], at_rows, found, pace)
        if used:
            change = vector - start
            pieces = [(k, change[at : at + PIECE]) for k, at in enumerate(range(0, len(change), PIECE))]
            # What the task has not met stays as it was; the first piece is always there and has the number of windows.
            pieces = [(k, piece) for k, piece in pieces if k == 0 or piece.any()]
            columns = [[k for k, _ in pieces], [used] * len(pieces), [squeezed(piece, "<f4") for _, piece in pieces]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary()))], names=["piece", "used", "x"])

    def added(piece: pa.Table) -> pa.Table:
        counts = piece["used"].to_pylist()
        total = sum(n * ints(piece, "x", row, "<f4").astype(np.float64) for row, n in enumerate(counts))
        return pa.table({"piece": piece["piece"][:1], "used": [sum(counts)], "x": pa.array([squeezed(total, "<f8")], pa.binary())})

    columns = ["trains", "bounds", "codes", "subs", "sub_bounds"]
    kinds = "piece int, used long, x binary"
    sums = blocks.select(*columns).mapInArrow(run, kinds).groupBy("piece").applyInArrow(added, kinds)
    # One row for each piece of the weights.
    sums = with_short_batches(blocks.sparkSession, sums.toArrow)
    if not sums.num_rows:
        return weights
    pieces, used = sums["piece"].to_pylist(), sums["used"].to_pylist()
    windows, after = used[pieces.index(0)], start.astype(np.float64)
    for row, k in enumerate(pieces):
        after[k * PIECE : (k + 1) * PIECE] += ints(sums, "x", row, "<f8") / windows
    return views(after.astype(np.float32), weights)


def stepped(weights: np.ndarray, moment: np.ndarray, square: np.ndarray, at: np.ndarray | slice, g: np.ndarray, pace: np.float32) -> None:
    """Changes the weights at these places by their gradients and the running means of these and of their squares."""
    g = g.astype(weights.dtype, copy=False)
    first, second = moment[at], square[at]
    first = first + (g - first) * np.float32(0.1)
    second = second + (g * g - second) * np.float32(0.02)
    moment[at], square[at] = first, second
    weights[at] -= pace * first / (np.sqrt(second) + np.float32(1e-7))


def log_probabilities(w: dict[str, np.ndarray], classes: Classes, sizes: np.ndarray, flat: np.ndarray, start_id: int) -> np.ndarray:
    """The base-10 logarithm of each document's probability."""
    windows, pair, targets, members = Windows(sizes), products(w), classes.of[flat], classes.member[flat]
    # What is no band's member has a fixed share of its class.
    logs = np.where(members > 0, 0, classes.log_share[flat])
    row_of = classes.row.astype(np.min_scalar_type(classes.rows))
    first, rows, there = windows.laid_out(row_of[inputs_of(sizes, flat, start_id)], np.ones(len(flat), bool))
    done, states, begin = 0, [], 0
    for at in range(0, len(windows.doc), BATCH_WINDOWS):
        chosen = first[at : at + BATCH_WINDOWS]
        here = there[chosen]
        z = attended(w, rows[chosen].astype(np.intp), here, pair)["z"].reshape(-1, WIDTH)
        # Windows in order score the places in order.
        full = np.flatnonzero(here[:, BEFORE:])
        aims = np.zeros(len(z), np.intp)
        aims[full] = targets[done : done + len(full)]
        logs[done : done + len(full)] += log_classes(w, z, aims)[full]
        done += len(full)
        states.append(z[full])
        if done - begin >= BAND_PLACES or done == len(flat):
            logs[begin:done] += log_members(w["own"], np.concatenate(states), members[begin:done], classes.bounds)
            states, begin = [], done
    return (np.add.reduceat(logs, windows.first) if len(sizes) else np.zeros(0)) / np.log(10)


def scored(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of docs.

    held_out rows are those whose crc32 of the id as text is divisible by ``folds``, and those
    without an id; nothing is learnt from them. Tokens are words between ASCII white space, A-Z
    in lower case, and one end. base_score adds up log10((c + 0.1) / (N + 0.1 (V + 1))) with a
    token's count c, all tokens N and distinct tokens V of the training rows; n_known counts
    tokens with c > 0, train_tokens is N. score is the log10 probability that the attention
    model gives to the text's subwords and end.

    Null and empty texts are the end alone. Rows that repeat an id are scored one by one and all
    count in training. Without a training row all counts are 0. An empty table gives no rows;
    other columns are not read.
    """
    spark = docs.sparkSession
    tokenizer = Tokenizer.from_file(tokenizer_path)
    size = tokenizer.get_vocab_size()
    start_id, end_id = tokenizer.token_to_id("<|startoftext|>"), tokenizer.token_to_id("<|endoftext|>")
    folder = run_dir(spark, "attention")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    blocks = stored(texts.mapInArrow(block_rows(tokenizer_path, folds), BLOCK).drop("words"), f"{folder}/blocks")

    known = stored(word_counts(blocks), f"{folder}/known")
    words, distinct = known.agg(F.sum("total"), F.sum("distinct")).first()
    documents = blocks.select(F.sum(F.size(F.filter("trains", lambda t: t)))).first()[0] or 0
    train_tokens = int(words or 0) + documents
    below = train_tokens + ADDED * ((distinct or 0) + (documents > 0) + 1)
    end_log = float(np.log10((documents + ADDED) / below))

    ends = np.array([(tokenizer.id_to_token(k) or "").endswith("</w>") for k in range(size)])
    classes = Classes(subword_counts(blocks, size, end_id), ends)
    weights = first_weights(classes)
    for number in range(ROUNDS):
        weights = trained(blocks, classes, weights, number, start_id, end_id)

    def score(block: pa.Table, known: pa.Table) -> pa.Table:
        bounds, codes = ints(block, "bounds"), ints(block, "codes")
        c = np.zeros(len(ints(block, "sub_bounds")) - 1)
        for row in range(known.num_rows):
            c[ints(known, "places", row)] = ints(known, "c", row, "<i8")
        n = np.diff(bounds)
        owner = np.repeat(np.arange(len(n)), n)
        base = np.bincount(owner, np.log10((c + ADDED) / below)[codes], len(n)) + end_log
        sizes, flat = sequences_of(block, end_id)
        columns = [
            block["ids"][0].values,
            pa.array(~np.asarray(block["trains"][0].values)),
            pa.array((n + 1).astype(np.int64)),
            pa.array(np.bincount(owner, c[codes] > 0, len(n)).astype(np.int64) + (documents > 0)),
            pa.array(np.full(len(n), train_tokens, np.int64)),
            pa.array(base),
            pa.array(log_probabilities(weights, classes, sizes, flat, start_id)),
        ]
        return pa.table(columns, names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    parts = blocks.select("block", "ids", "trains", "bounds", "codes", "subs", "sub_bounds").groupBy("block")
    found = saved(parts.cogroup(known.select("block", "places", "c").groupBy("block")).applyInArrow(score, SCORES))
    remove_dir(spark, folder)
    return found
