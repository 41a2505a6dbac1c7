"""Packing documents into fixed-length sequences with a grouping genetic algorithm.

Token pieces are dealt by a hash of their key into cells of bounded size. For each
cell several islands evolve packings of its pieces: a child takes whole well-filled
sequences from one parent, keeps the other parent's sequences that share nothing
with them, and places the displaced pieces by best fit. Between epochs every
island's elite moves to the next island of its cell, which is the only shuffle of
packings. A cell stops early once an elite meets the lower bound of its total.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress, repeat
from string import ascii_lowercase, digits
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm.common import saved
from orderlens.llm.words import bytes_of, byte_table, slices, split_at_spaces

CELL_PIECES = 8_192
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 3
POPULATION = 4
#: Share of a sequence that counts as well filled.
WELL_FILLED = 0.995
#: Bytes of text tokenized at a time.
SLICE_BYTES = 1 << 20
#: Words whose ids a task keeps at most, but for those of one slice.
KEPT_WORDS = 200_000

PIECES = "id long, piece int, start long, ids array<int>"
STATE = "cell long, island int, lengths binary, packing binary, bins long, bound long, fitness double"


class IdStore:
    """Ids of words: those of the word numbered k are ``ids[ends[k] - sizes[k] : ends[k]]``."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.sizes, self.ends, self.ids = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.int32)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers, -1 for those that are not here."""
        return np.fromiter(map(self.number.get, words, repeat(-1)), np.int32, len(words))

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids) of the words with these numbers, one after another."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes, dtype=np.int32)
        at = np.repeat(self.ends[numbers] - ends, sizes)
        at += np.arange(len(at), dtype=np.int32)
        return sizes, self.ids[at]

    def add(self, words: list[bytes], sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The numbers of words that are new here, now with their ids."""
        first = len(self.sizes)
        self.number.update(zip(words, range(first, first + len(words))))
        self.sizes = np.concatenate((self.sizes, sizes.astype(np.int32)))
        self.ends = np.concatenate((self.ends, len(self.ids) + np.cumsum(sizes, dtype=np.int32)))
        self.ids = np.concatenate((self.ids, ids.astype(np.int32)))
        return np.arange(first, first + len(words), dtype=np.int32)


#: Whether characters are lower-case letters up to U+024F that normalising keeps, by code point.
LOWER = np.array([c < 0x250 and chr(c).isalpha() and chr(c).islower() and is_normalized("NFC", chr(c)) for c in range(0x280)])
#: Kinds of bytes once A-Z are lower-cased: 1 letters, 2 signs, 0 others.
KINDS = bytes(1 if chr(c) in ascii_lowercase else 2 if 32 < c < 127 and chr(c) not in digits else 0 for c in range(256))


def short_letters(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lead, there): first bytes of the characters of two bytes up to U+027F in UTF-8, and which are letters of ``LOWER``."""
    lead = np.flatnonzero((text[:-1] >= 0xC2) & (text[:-1] <= 0xC9) & (text[1:] & 0xC0 == 0x80))
    return lead, LOWER[((text[lead].astype(np.int32) & 0x1F) << 6) | (text[lead + 1] & 0x3F)]


def plain_words(words: list[bytes], text: np.ndarray) -> np.ndarray:
    """Which of the words, joined by spaces in ``text``, hold nothing but letters of ``LOWER``."""
    fine = LOWER[np.minimum(text, 127)]
    lead, there = short_letters(text)
    fine[lead] = fine[lead + 1] = there
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    fine[starts[1:] - 1] = True
    return np.logical_and.reduceat(fine, starts)


class WordIds:
    """Token ids of texts, word by word.

    For a tokenizer whose normaliser and splitter drop white space and tell letters
    from signs, no token spans two words, nor a letter and a sign behind
    it. A text's ids are then those of its parts in order. The ids of the last
    ``KEPT_WORDS`` parts are kept in two generations: what is met again moves to
    the newer one, the older one is dropped when the newer is half full. Parts that normalising and splitting
    leave as they are go to the tokenizer's model directly; others are encoded many
    in one call, with a sign of one token between them.
    """

    MARK = "|"

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.known, self.older = IdStore(), IdStore()
        ids = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids
        self.mark = ids[0] if len(ids) == 1 else None
        # The visible sign that stands for each byte in a byte-level vocabulary; a space stays one.
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.signs = np.arange(256, dtype="<u4")
        hidden = [b for b in range(256) if b not in visible]
        self.signs[hidden] = 256 + np.arange(len(hidden))
        self.signs[ord(" ")] = ord(" ")
        # The model alone, on words in such signs, and which of its tokens end a word.
        self.model = Tokenizer(self.tokenizer.model)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.array([bool(suffix) and (self.tokenizer.id_to_token(k) or "").endswith(suffix) for k in range(self.tokenizer.get_vocab_size())], bool)

    def modelled(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids) that the model alone gives to words, one after another."""
        fast, options = getattr(self.model, "encode_batch_fast", None), {"is_pretokenized": True, "add_special_tokens": False}
        found = fast([words], **options)[0] if fast else self.model.encode(words, **options)
        ids = np.array(found.ids, np.int32)
        # A word has one token at most that ends words, its last; only if all have theirs do these tell words apart.
        last = np.flatnonzero(self.last[ids])
        if len(last) == len(words) and last[-1] == len(ids) - 1:
            return np.diff(last, prepend=-1), ids
        found = self.model.encode(words, **options) if fast else found
        return np.bincount(np.array(found.word_ids), minlength=len(words)), np.array(found.ids)

    def learn(self, words: list[bytes]) -> np.ndarray:
        """The numbers that words get in ``known``, which lacks them."""
        numbers = np.empty(len(words), np.int32)
        if not words:
            return numbers
        plain = plain_words(words, np.frombuffer(b" ".join(words), np.uint8))
        simple, others, single = list(compress(words, plain.tolist())), np.flatnonzero(~plain).tolist(), []
        first = len(self.known.sizes)
        for at in range(0, len(simple), 5000):
            part = simple[at : at + 5000]
            signs = self.signs[np.frombuffer(b" ".join(part), np.uint8)]
            self.known.add(part, *self.modelled(signs.tobytes().decode("utf-32-le").split(" ")))
        numbers[plain] = np.arange(first, first + len(simple))
        for at in range(0, len(others), 1000):
            part = [k for k in others[at : at + 1000] if self.mark is not None and self.MARK.encode() not in words[k]]
            text = f" {self.MARK} ".join(words[k].decode("utf-8", "replace") for k in part)
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
            cuts = np.flatnonzero(ids == self.mark)
            if part and len(cuts) == len(part) - 1:
                sizes = np.diff(np.concatenate(([-1], cuts, [len(ids)]))) - 1
                numbers[part] = self.known.add([words[k] for k in part], sizes, ids[ids != self.mark])
                single += sorted({*others[at : at + 1000]} - {*part})
            else:
                single += others[at : at + 1000]
        for k in single:
            ids = np.array(self.tokenizer.encode(words[k].decode("utf-8", "replace"), add_special_tokens=False).ids, np.int32)
            numbers[k] = self.known.add([words[k]], np.array([len(ids)]), ids)[0]
        return numbers

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The numbers of different words in ``known``, which takes in those that it lacks."""
        if 2 * len(self.known.number) > KEPT_WORDS:
            self.older, self.known = self.known, IdStore()
        numbers = self.known.numbers(words)
        new = np.flatnonzero(numbers < 0)
        lacking = [words[k] for k in new.tolist()]
        old = self.older.numbers(lacking)
        met = old >= 0
        numbers[new[met]] = self.known.add(list(compress(lacking, met.tolist())), *self.older.of(old[met]))
        numbers[new[~met]] = self.learn(list(compress(lacking, (~met).tolist())))
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(bounds, ids): the ids of text k are ``ids[bounds[k] : bounds[k + 1]]``."""
        offsets, data = bytes_of(texts)
        raw = data.tobytes()
        # Names of special tokens must stay whole, and ones in capitals must stay ordinary text.
        # A dot above joins I, but not i, before marks are put in order.
        special = b"<|" in raw or "\u0307".encode() in raw
        raw = raw.translate(byte_table(lower=not special).tobytes())
        data = np.frombuffer(bytearray(raw), np.uint8)
        if not special:
            kinds = np.frombuffer(bytearray(raw.translate(KINDS)), np.uint8)
            lead, there = short_letters(data)
            # Capitals from U+00C0 to U+00DE lie 32 below their small letters; U+00D7 is a sign.
            high = lead[(data[lead] == 0xC3) & (data[lead + 1] < 0x9F) & (data[lead + 1] != 0x97)]
            data[high + 1] += 0x20
            kinds[lead[there] + 1] = kinds[high + 1] = 1
            cuts = np.flatnonzero((kinds[:-1] == 1) & (kinds[1:] == 2)) + 1
            data = np.insert(data, cuts, ord(" "))
            offsets = offsets + np.searchsorted(cuts, offsets)
        owner, words = split_at_spaces(offsets, data)
        coded = words.dictionary_encode()
        numbers = self.numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes, ids = self.known.of(numbers[np.asarray(coded.indices)])
        bounds = np.concatenate(([0], np.cumsum(np.bincount(owner, sizes, len(offsets) - 1)))).astype(np.int64)
        return bounds, ids


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    finish: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
    schema: str = PIECES,
) -> DataFrame:
    """(id, piece, start, ids): each document's ids and ``end_id``, cut every ``capacity`` ids.

    A null or empty text is the one id ``end_id``. ``finish`` turns each batch of
    these columns into one of ``schema`` before it leaves the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer_path)
        for batch in batches:
            for first, part in slices(batch.column(1), SLICE_BYTES):
                owner, number, start, chunks = [], [], [], []
                ids = batch.column(0).slice(first, len(part)).to_pylist()
                bounds, flat_ids = words.encode(part)
                for doc, a, b in zip(ids, bounds[:-1], bounds[1:]):
                    tokens = np.append(flat_ids[a:b], np.int32(end_id))
                    for k, at in enumerate(range(0, len(tokens), capacity)):
                        owner.append(doc)
                        number.append(k)
                        start.append(at)
                        chunks.append(tokens[at : at + capacity])
                offsets = np.concatenate(([0], np.cumsum([len(c) for c in chunks])))
                flat = np.concatenate(chunks) if chunks else np.empty(0, np.int32)
                out = pa.RecordBatch.from_arrays(
                    [
                        pa.array(owner, pa.int64()),
                        pa.array(number, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())),
                    ],
                    names=["id", "piece", "start", "ids"],
                )
                yield finish(out) if finish else out

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, order: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Place the pieces in this order, each where the least room is left; ``bins`` and ``room`` change."""
    at: dict[int, list[int]] = {}
    mask = 0
    for b, left in enumerate(room):
        if left:
            at.setdefault(left, []).append(b)
            mask |= 1 << left
    for k, size in zip(order.tolist(), lengths[order].tolist()):
        fits = mask >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            same = at[left]
            b = same.pop()
            if not same:
                mask ^= 1 << left
        else:
            left, b = capacity, len(room)
            room.append(capacity)
        bins[k] = b
        left -= size
        room[b] = left
        if left:
            at.setdefault(left, []).append(b)
            mask |= 1 << left


def crossed(lengths: np.ndarray, giver: np.ndarray, keeper: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """A child: some well-filled sequences of the giver, the keeper's others, the rest by best fit."""
    fill = np.bincount(giver, lengths)
    chosen = (fill >= WELL_FILLED * capacity) & (rng.random(len(fill)) < 0.5)
    injected = chosen[giver]
    touched = np.zeros(keeper.max() + 1, bool)
    touched[keeper[injected]] = True
    kept = ~touched[keeper]
    names = np.concatenate((np.unique(giver[injected]), np.unique(keeper[kept])))
    split = len(np.unique(giver[injected]))
    child = np.full(len(lengths), -1, np.int64)
    child[injected] = np.searchsorted(names[:split], giver[injected])
    child[kept] = split + np.searchsorted(names[split:], keeper[kept])
    placed = child >= 0
    room = (capacity - np.bincount(child[placed], lengths[placed], len(names))).astype(int).tolist()
    loose = np.flatnonzero(~placed)
    loose = loose[np.argsort(-lengths[loose], kind="stable")]
    best_fit(lengths, loose, child, room, capacity)
    return child


def quality(lengths: np.ndarray, packing: np.ndarray, capacity: int) -> tuple[int, float]:
    """(number of sequences, mean square of their fill): fewer is better, then fuller ones."""
    fill = np.bincount(packing, lengths) / capacity
    return len(fill), float((fill**2).mean()) if len(fill) else 0.0


def evolved(lengths: np.ndarray, packings: list[np.ndarray], capacity: int, seed: int) -> list[np.ndarray]:
    """The island's population after ``GENERATIONS`` generations, best first."""
    rng = np.random.default_rng(seed)
    bound = -(-int(lengths.sum()) // capacity)

    def rank(packing: np.ndarray) -> tuple[int, float]:
        n, full = quality(lengths, packing, capacity)
        return n, -full

    people = sorted(packings, key=rank)
    while len(people) < POPULATION and rank(people[0])[0] > bound if people else True:
        noise = rng.random(len(lengths)) * (0.0 if not people else 0.2) + 1
        packing = np.full(len(lengths), -1, np.int64)
        best_fit(lengths, np.argsort(-lengths * noise, kind="stable"), packing, [], capacity)
        people = sorted([*people, packing], key=rank)
    for _ in range(GENERATIONS):
        if rank(people[0])[0] <= bound or len(people) < 2:
            break
        children = []
        for _ in range(POPULATION):
            a, b = rng.permutation(min(len(people), POPULATION))[:2]
            children.append(crossed(lengths, people[a], people[b], capacity, rng))
        people = sorted([*people, *children], key=rank)[:POPULATION]
    return people[:POPULATION]


def packed(
    pieces: DataFrame, capacity: int = 2048, length_col: str = "length", seed: int = 7
) -> DataFrame:
    """pieces with sequence_id and offset: no sequence holds more than ``capacity``.

    pieces has id, piece and a length from 1 to ``capacity``; its other columns are
    kept. Offsets in a sequence are gapless from 0. Pieces of full length are
    sequences of their own. An empty table gives no rows; pieces with equal keys
    and lengths stand for one another.
    """
    pieces = saved(pieces)
    n = pieces.count()
    cells = max(1, -(-n // CELL_PIECES))
    dealt = pieces.withColumn("cell", F.pmod(F.xxhash64("id", "piece"), F.lit(cells)))

    def in_order(table: pa.Table) -> pa.Table:
        return table.sort_by([(c, "ascending") for c in ("id", "piece", length_col)])

    state_schema = pa.schema(
        [("cell", pa.int64()), ("island", pa.int32()), ("lengths", pa.binary()), ("packing", pa.binary()), ("bins", pa.int64()), ("bound", pa.int64()), ("fitness", pa.float64())]
    )

    def founded(key: tuple, table: pa.Table) -> pa.Table:
        lengths = np.asarray(in_order(table)[length_col], np.int64)
        lengths = lengths[lengths < capacity]
        rows = {k: [] for k in state_schema.names}
        for island in range(ISLANDS):
            people = evolved(lengths, [], capacity, seed * 1000 + island) if len(lengths) else [lengths]
            add(rows, key[0].as_py(), island, lengths, people)
        return pa.table(rows, schema=state_schema)

    def add(rows: dict, cell: int, island: int, lengths: np.ndarray, people: list[np.ndarray]) -> None:
        for packing in people:
            bins, fitness = quality(lengths, packing, capacity) if len(lengths) else (0, 0.0)
            bound = -(-int(lengths.sum()) // capacity)
            values = (cell, island, lengths.astype("<i4").tobytes(), packing.astype("<i4").tobytes(), bins, bound, fitness)
            for column, value in zip(rows.values(), values):
                column.append(value)

    def epoch(number: int) -> Callable[[tuple, pa.Table], pa.Table]:
        def run(key: tuple, table: pa.Table) -> pa.Table:
            lengths = np.frombuffer(table["lengths"][0].as_py(), "<i4").astype(np.int64)
            people = [np.frombuffer(p, "<i4").astype(np.int64) for p in table["packing"].to_pylist()]
            rows = {k: [] for k in state_schema.names}
            if len(lengths):
                people = evolved(lengths, people, capacity, seed * 1000 + number * 100 + key[1].as_py())
            add(rows, key[0].as_py(), key[1].as_py(), lengths, people[:POPULATION])
            return pa.table(rows, schema=state_schema)

        return run

    state = saved(dealt.select("cell", "id", "piece", length_col).groupBy("cell").applyInArrow(founded, STATE))
    rank = F.struct("bins", (-F.col("fitness")).alias("worth"), "island", "packing")
    for number in range(1, EPOCHS + 1):
        if not state.groupBy("cell").agg(F.min(F.col("bins") - F.col("bound")).alias("over")).filter("over > 0").limit(1).count():
            break
        best = state.groupBy("cell", "island", "lengths", "bound").agg(F.min(rank).alias("best"))
        elites = best.select(
            "cell", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), "lengths", "best.packing", "best.bins", "bound", (-F.col("best.worth")).alias("fitness")
        )
        state = saved(state.unionByName(elites).groupBy("cell", "island").applyInArrow(epoch(number), STATE))
    elite = state.groupBy("cell").agg(F.min(rank).alias("best")).select("cell", "best.packing")

    def placed(key: tuple, items: pa.Table, best: pa.Table) -> pa.Table:
        items = in_order(items)
        lengths = np.asarray(items[length_col], np.int64)
        bins = np.empty(len(lengths), np.int64)
        part = lengths < capacity
        packing = np.frombuffer(best["packing"][0].as_py(), "<i4").astype(np.int64)
        bins[part] = packing
        bins[~part] = (packing.max() + 1 if len(packing) else 0) + np.arange((~part).sum())
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.concatenate(([True], np.diff(bins[order]) > 0))
        offsets = np.empty(len(lengths), np.int64)
        offsets[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        items = items.drop_columns(["cell"])
        cell = key[0].as_py()
        return items.append_column("sequence_id", pa.array((cell << 32) + bins)).append_column("offset", pa.array(offsets))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.groupBy("cell").cogroup(elite.groupBy("cell")).applyInArrow(placed, f"{fields}, sequence_id long, offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids) from packed pieces that carry their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
