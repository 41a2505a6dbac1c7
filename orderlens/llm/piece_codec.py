"""Sentence-piece encoding that keeps every piece's place in the source, and decoding.

The text is normalised here, by the longest prefix in the model's compiled character
map, and each normalised byte keeps the source byte it came from. A copy of the
model whose own normaliser does nothing segments the result, and the byte length of
every piece projects it back to a span of the original bytes. Where the map is empty
and no white space is dropped, the alignment is a running sum over piece lengths.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.words import slices

SPACE = "▁"
ENCODED = "id long, ids array<int>, starts array<int>, ends array<int>, decoded string"
BYTE_PIECE = 6


def fields(message: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """(number, value, raw bytes) of the fields of a protobuf message, in order."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            value, at, shift = value | (byte & 127) << shift, at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(message):
        start = at
        tag, at = number(at)
        kind = tag & 7
        if kind == 0:
            value, at = number(at)
        elif kind == 2:
            size, at = number(at)
            value, at = message[at : at + size], at + size
        else:
            size = {1: 8, 5: 4}[kind]
            value, at = message[at : at + size], at + size
        yield tag >> 3, value, message[start:at]


class CharMap:
    """The compiled character map: a double-array trie from byte strings to replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(length, replacement) of the longest entry that the data has at this place."""
        if not self.units:
            return None
        found, unit, node = None, self.units[0], 0
        node ^= self._offset(unit)
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = k + 1 - at, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        stop = self.texts.index(b"\0", found[1])
        return found[0], self.texts[found[1] : stop]

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)


class PieceCodec:
    """A sentence-piece model: normaliser with alignment, segmentation, decoding."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        spec: dict[int, int | bytes] = {}
        others, pieces = [], []
        for number, value, raw in fields(model):
            if number == 3:
                spec = {k: v for k, v, _ in fields(value)}
            else:
                others.append(raw)
                if number == 1:
                    pieces.append({k: v for k, v, _ in fields(value)})
        self.chars = CharMap(spec.get(2, b""))
        self.prefix, self.squeeze, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        plain = b"\x0a\x08identity\x18\x00\x20\x00\x28\x00"
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=b"".join(others) + b"\x1a" + bytes([len(plain)]) + plain)
        mark = SPACE.encode()
        self.length = np.array([1 if p.get(3) == BYTE_PIECE else len(p[1]) for p in pieces], np.int64)
        self.source_length = np.array([1 if p.get(3) == BYTE_PIECE else len(p[1].replace(mark, b" ")) for p in pieces], np.int64)
        self.identity = not self.chars.units and not self.squeeze and self.escape
        self.unknown = self.library.unk_id()

    def normalised(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the source byte."""
        data, mark = text.encode("utf-8"), SPACE.encode() if self.escape else b" "
        parts: list[bytes] = []
        source: list[int] = []

        def put(part: bytes, at: int) -> None:
            parts.append(part)
            source.extend([at] * len(part))

        chunks, at = [], 0
        while at < len(data):
            match = self.chars.longest(data, at)
            if match is None:
                first = data[at]
                size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                match = size, data[at : at + size]
            chunks.append((at, match[1]))
            at += match[0]
        end = len(data)
        if self.squeeze:
            while chunks and not chunks[0][1].strip(b" "):
                chunks.pop(0)
        if not chunks:
            return "", np.zeros(1, np.int64)
        if self.prefix:
            put(mark, chunks[0][0])
        after_space = self.squeeze
        for at, chunk in chunks:
            if after_space:
                chunk = chunk.lstrip(b" ")
            if not chunk:
                continue
            for byte in (chunk[k : k + 1] for k in range(len(chunk))):
                put(mark if byte == b" " else byte, at)
            after_space = self.squeeze and chunk.endswith(b" ")
        while self.squeeze and parts and parts[-1] == mark:
            end = source[-1]
            del source[len(source) - len(parts.pop()) :]
        return b"".join(parts).decode("utf-8", "replace"), np.array([*source, end], np.int64)

    def encode(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
        """(ids, first source bytes, source bytes behind the end)."""
        if not text:
            return [], np.empty(0, np.int64), np.empty(0, np.int64)
        if self.identity and SPACE not in text:
            ids = self.segmenter.encode((SPACE if self.prefix else "") + text.replace(" ", SPACE))
            if self.unknown not in ids:
                ends = np.cumsum(self.source_length[ids]) - self.prefix
                return ids, np.concatenate((np.zeros(min(1, len(ids)), np.int64), ends[:-1])), ends
        norm, source = self.normalised(text)
        ids = self.segmenter.encode(norm)
        lengths = self.length[ids]
        if self.unknown in ids:
            pieces = self.segmenter.encode(norm, out_type=str)
            lengths = np.array([len(p.encode()) if i == self.unknown else n for i, p, n in zip(ids, pieces, lengths)], np.int64)
        ends = np.cumsum(lengths)
        return ids, source[ends - lengths], source[ends]


def encoded(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    finish: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
    schema: str = ENCODED,
) -> DataFrame:
    """(id, ids, starts, ends, decoded) of every row of docs, in one pass without a shuffle.

    ids are the model's for the whole text, without begin or end ids; starts and ends
    are byte offsets into the text in UTF-8; decoded is the library's text of the ids.
    A null or empty text has no ids and decodes to the empty text. Every row is
    answered by itself, so ids that repeat or are null come back as they are. The
    model is read at ``model_path`` on every executor. ``finish`` turns each batch
    of these columns into one of ``schema`` before it leaves the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(model_path, "rb") as file:
            codec = PieceCodec(file.read())
        for batch in batches:
            for start, part in slices(batch.column(1)):
                texts = [t.decode("utf-8", "replace") if t else "" for t in part.cast(pa.binary()).to_pylist()]
                rows = [codec.encode(t) for t in texts]
                ids, starts, ends = ([r[k] for r in rows] for k in range(3))
                out = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(part))]
                    + [lists(x) for x in (ids, starts, ends)]
                    + [pa.array([codec.library.decode(i) if i else "" for i in ids], pa.string())],
                    names=["id", "ids", "starts", "ends", "decoded"],
                )
                yield finish(out) if finish else out

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def lists(values: list) -> pa.ListArray:
    """A list column of 32-bit integers."""
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values])))
    flat = np.concatenate([np.asarray(v, np.int32) for v in values]) if values else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(np.int32), pa.int32()))
