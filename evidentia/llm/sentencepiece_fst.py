"""SentencePiece encoding and decoding as a weighted finite-state transducer, for merge (BPE) models with byte fallback.

Compiled once: the normaliser (a space becomes U+2581, one is put before the text), an arc per piece, and arcs from a
character without a piece to its bytes. A state is a place in the text and the piece that ended there. An arc weighs 0
where the merges themselves would leave its piece next to the one before it, and infinity else: a segmentation is the
merge result exactly if each two neighbours are, so one path is finite and the tropical shortest path finds it, place by
place. All pieces made of U+2581 alone share one lowest score, which leaves no order between them but left to right;
their runs are therefore joined after the path, from a table by length.

Characters that are neighbours in no piece are never joined, so the input is composed part by part and parts that recur
are looked up. Null text counts as empty and has no ids. Each row gives one row.
"""

from __future__ import annotations

import heapq
import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import bounded_batches, owns, text_or_empty

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGES = 2
#: Parts and neighbours remembered by one worker, and the longest stretch.
REMEMBERED, NEIGHBOURS, LONGEST = 600_000, 500_000, 64
_LOADED: dict[str, Transducer] = {}
owns("sentencepiece", _LOADED.clear)


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind)
            size = varint() if size is None else size
            yield key >> 3, raw[at : at + size]
            at += size


def read_model(raw: bytes) -> tuple[list[tuple[str, float, int]], dict, dict]:
    """Pieces (text, score, type), trainer and normaliser settings of a model file."""
    pieces, trainer, normaliser = [], {}, {}
    for field, value in _fields(raw):
        if field == 1:
            piece = dict(_fields(value))
            pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0], piece.get(3, NORMAL)))
        elif field == 2:
            trainer = dict(_fields(value))
        elif field == 3:
            normaliser = dict(_fields(value))
    return pieces, trainer, normaliser


class Transducer:
    def __init__(self, raw: bytes):
        self.pieces, trainer, normaliser = read_model(raw)
        if trainer.get(3, 1) != MERGES or normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(5, 1) or any(k == USER_DEFINED for *_, k in self.pieces):
            raise ValueError("only merge models with the identity normaliser are compiled")
        self.prefix = bool(normaliser.get(3, 1))
        self.ids = {text: k for k, (text, _, kind) in enumerate(self.pieces) if kind in (NORMAL, UNUSED)}
        self.bytes = {int(text[3:5], 16): k for k, (text, _, kind) in enumerate(self.pieces) if kind == BYTE}
        self.unknown = next(k for k, (*_, kind) in enumerate(self.pieces) if kind == UNKNOWN)
        self.merged = {text: self.pieces[k][1] for text, k in self.ids.items() if len(text) > 1 and text.strip(MARK)}
        self.longest = max(map(len, self.merged), default=1)
        self.joined = {pair for text in self.merged for pair in zip(text, text[1:], strict=False)}
        if any(MARK in text[1:] for text in self.merged):
            raise ValueError("pieces that reach over words are not compiled")
        self.mark = self.ids.get(MARK, -1)
        self.emitted = [b"" if kind == CONTROL else bytes([int(text[3:5], 16)]) if kind == BYTE else " ⁇ ".encode() if kind == UNKNOWN else text.replace(MARK, " ").encode() for text, _, kind in self.pieces]
        self.weights: dict[tuple[str, str], float] = {}
        self.parts: dict[str, bytes] = {}
        self.stretches: dict[str, bytes] = {}
        self.runs: dict[int, list[int]] = {}

    @classmethod
    def shared(cls, path: str) -> Transducer:
        """One transducer for a worker process."""
        if path not in _LOADED:
            with open(path, "rb") as file:
                _LOADED[path] = cls(file.read())
        return _LOADED[path]

    def _merge(self, symbols: list[str], score) -> list[str]:
        """The merges by themselves: the best pair first, the leftmost of equals."""
        after = [*range(1, len(symbols)), -1]
        before = list(range(-1, len(symbols) - 1))
        agenda: list[tuple[float, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (s := score(symbols[a] + symbols[b])) is not None:
                heapq.heappush(agenda, (-s, a, b, len(symbols[a]) + len(symbols[b])))

        for k in range(len(symbols) - 1):
            offer(k, k + 1)
        while agenda:
            _, a, b, size = heapq.heappop(agenda)
            if not symbols[a] or not symbols[b] or len(symbols[a]) + len(symbols[b]) != size or after[a] != b:
                continue
            symbols[a] += symbols[b]
            symbols[b] = ""
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [s for s in symbols if s]

    def weight(self, left: str, right: str) -> float:
        """0 where the merges leave the two pieces as they are, infinity where they would not."""
        known = self.weights.get((left, right))
        if known is None:
            known = 0.0 if self._merge([*left, *right], self.merged.get) == [left, right] else math.inf
            if len(self.weights) >= NEIGHBOURS:
                self.weights.clear()
            self.weights[left, right] = known
        return known

    def _path(self, part: str) -> list[str]:
        """Pieces along the shortest path through one part."""
        best, last = [0.0] + [math.inf] * len(part), [""] * (len(part) + 1)
        for end in range(1, len(part) + 1):
            for start in range(end - 1, max(-1, end - 1 - self.longest), -1):
                piece = part[start:end]
                if end - start > 1 and piece not in self.merged or best[start] == math.inf:
                    continue
                weight = best[start] + (self.weight(last[start], piece) if start else 0.0)
                if weight < best[end]:
                    best[end], last[end] = weight, piece
                    break  # no other path to this place is finite
        out, end = [], len(part)
        while end:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def _emit(self, piece: str) -> list[int]:
        if piece in self.ids:
            return [self.ids[piece]]
        return [self.bytes.get(b, self.unknown) for b in piece.encode("utf-8", "surrogatepass")] if self.bytes else [self.unknown]

    def _part(self, part: str) -> bytes:
        """Ids of a part without spaces, cut where its neighbours are joined by no piece."""
        joined, known = self.joined, self.stretches
        ends = [k for k, pair in enumerate(zip(part, part[1:], strict=False), 1) if pair not in joined]
        out, start = [], 0
        for end in [*ends, len(part)]:
            stretch = part[start:end]
            ids = known.get(stretch)
            if ids is None:
                ids = np.array([i for piece in self._path(stretch) for i in self._emit(piece)], "<u4").tobytes()
                if end - start <= LONGEST and len(known) < REMEMBERED:
                    known[stretch] = ids
            out.append(ids)
            start = end
        return b"".join(out)

    def _run(self, length: int) -> list[int]:
        """Ids of so many marks that no other piece took."""
        if length not in self.runs:
            of_marks = lambda text: self.pieces[self.ids[text]][1] if text in self.ids else None
            self.runs[length] = [i for s in self._merge([MARK] * length, of_marks) for i in self._emit(s)]
        return self.runs[length]

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        words = text.replace(MARK, " ").split(" ")
        if not self.prefix:
            raise ValueError("only models with a space before the text are compiled")
        known = self.parts
        new = set(words).difference(known)
        for word in new:
            known[word] = self._part(MARK + word)
        out = list(map(known.__getitem__, words))
        if len(known) > REMEMBERED:
            for word in new:
                del known[word]
        if "" not in words:
            return b"".join(out)
        alone, joined, run = np.array([self.mark], "<u4").tobytes(), [], 0
        for ids in out:
            if ids == alone:
                run += 1
                continue
            if run and ids.startswith(alone):
                run, ids = run + 1, ids[4:]
            if run:
                joined.append(np.array(self._run(run), "<u4").tobytes())
                run = 0
            joined.append(ids)
        if run:
            joined.append(np.array(self._run(run), "<u4").tobytes())
        return b"".join(joined)

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are not UTF-8 become U+FFFD."""
        out = b"".join(map(self.emitted.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
        return out[1:] if self.prefix and out.startswith(" ") else out


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tool = Transducer.shared(path)
    for batch in batches:
        ids = [tool.encode(text) for text in batch.column(1).to_pylist()]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]), pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "ids"])


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and ids (array of int) of every whole text."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(lambda b: _encoded(b, model), "doc_id long, ids array<int>")


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tool = Transducer.shared(path)
    for batch in batches:
        texts = [tool.decode(np.array(ids, "<u4").tobytes()) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])


def decode(coded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids."""
    bounded_batches(coded.sparkSession)
    return coded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(lambda b: _decoded(b, model), "doc_id long, text string")


def _digest(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tool = Transducer.shared(path)
    fallback = np.zeros(len(tool.pieces), bool)
    fallback[list(tool.bytes.values())] = True
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = tool.encode(text)
            rows.append((doc_id, len(ids) // 4, int(fallback[np.frombuffer(ids, "<u4")].sum()), zlib.crc32(ids), tool.decode(ids) == text))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.bool_()], strict=True)], names=["doc_id", "n_pieces", "n_byte_pieces", "ids_crc32", "round_trip"])


def digest(docs: DataFrame, model: str) -> DataFrame:
    """Per row: doc_id, n_pieces, n_byte_pieces, ids_crc32 and whether decoding gives the text again."""
    bounded_batches(docs.sparkSession)
    schema = "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, round_trip boolean"
    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(lambda b: _digest(b, model), schema)
