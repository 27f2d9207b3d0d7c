"""Static range asymmetric numeral system over token ids, in blocks that decode by themselves.

A block holds whole documents. Its ids are cut into segments of STEPS rows of LANES interleaved coders. Every segment
begins at a checkpoint (the coders' states and the place in the stream) and has a checksum of its own, so segments
decode in parallel and in any order. All blocks use one table of symbol frequencies, named by its crc32.

Layout, little-endian: MAGIC, table crc32 u32, documents u32, ids u64, segments u32, crc32 of the document index u32;
document ids i64[], document lengths u32[]; per segment stream words u32, checksum u32; states u64[segments, LANES];
streams u32[].
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

MAGIC = b"EVRANS1\0"
LANES, STEPS = 64, 256
SEGMENT = LANES * STEPS
SCALE = 20
LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<8sIIQII")


@dataclass(frozen=True)
class Table:
    """Frequencies that sum to 2**SCALE, one at least for every symbol that occurs."""

    freq: np.ndarray
    cum: np.ndarray
    symbol: np.ndarray
    crc: int

    @classmethod
    def of(cls, counts: np.ndarray) -> Table:
        counts = np.asarray(counts, np.int64)
        whole = 1 << SCALE
        if np.count_nonzero(counts) > whole:
            raise ValueError("more symbols than the scale has places")
        freq = np.zeros(len(counts), np.int64)
        if total := int(counts.sum()):
            freq = np.where(counts > 0, np.maximum(1, (counts.astype(np.float64) * (whole / total)).astype(np.int64)), 0)
            while (over := int(freq.sum()) - whole) > 0:
                spare = np.maximum(freq - 1, 0)
                freq -= np.minimum(spare, -(-spare * over // max(1, int(spare.sum()))))
            freq[int(np.argmax(freq))] += whole - int(freq.sum())
        return cls.from_frequencies(freq)

    @classmethod
    def from_frequencies(cls, freq: np.ndarray) -> Table:
        freq = np.asarray(freq, np.uint64)
        cum = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64) if len(freq) else freq
        return cls(freq, cum, np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64)), zlib.crc32(freq.astype("<u4").tobytes()))


def encode(table: Table, doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """A block of whole documents; ids is their concatenation."""
    segments = -(-len(ids) // SEGMENT)
    filler = int(np.argmax(table.freq)) if len(table.freq) else 0
    padded = np.full(segments * SEGMENT, filler, np.uint32)
    padded[: len(ids)] = ids
    grid = padded.reshape(segments, STEPS, LANES)
    state = np.full((segments, LANES), LOW, np.uint64)
    words = np.zeros((segments, SEGMENT), np.uint32)
    place = np.full(segments, SEGMENT, np.int64)
    shift, scale, low32 = np.uint64(32), np.uint64(SCALE), np.uint64(0xFFFFFFFF)
    for step in range(STEPS - 1, -1, -1):
        f, c = table.freq[grid[:, step]], table.cum[grid[:, step]]
        full = state >= f << np.uint64(63 - SCALE)
        rank = full.cumsum(axis=1)
        place -= rank[:, -1]
        rows, lanes = full.nonzero()
        words[rows, place[rows] + rank[rows, lanes] - 1] = state[rows, lanes] & low32
        state = np.where(full, state >> shift, state)
        q = state // f
        state = (q << scale) + (state - q * f) + c
    streams = [words[k, place[k] :].astype("<u4").tobytes() for k in range(segments)]
    index = np.asarray(doc_ids, "<i8").tobytes() + np.asarray(lengths, "<u4").tobytes()
    head = _HEAD.pack(MAGIC, table.crc, len(doc_ids), len(ids), segments, zlib.crc32(index))
    states = state.astype("<u8")
    checks = np.array([(len(s) // 4, zlib.crc32(states[k].tobytes() + s)) for k, s in enumerate(streams)], "<u4").reshape(-1, 2)
    return head + index + checks.tobytes() + states.tobytes() + b"".join(streams)


def decode(table: Table, block: bytes, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, document lengths and ids of a block; ids only of the segments from first up to last, where given."""
    magic, crc, docs, n, segments, index_crc = _HEAD.unpack_from(block)
    if magic != MAGIC or crc != table.crc:
        raise ValueError("not a block of this table")
    at = _HEAD.size
    if zlib.crc32(block[at : at + docs * 12]) != index_crc:
        raise ValueError("document index is damaged")
    doc_ids, lengths = np.frombuffer(block, "<i8", docs, at), np.frombuffer(block, "<u4", docs, at + docs * 8)
    at += docs * 12
    checks = np.frombuffer(block, "<u4", segments * 2, at).reshape(segments, 2)
    at += segments * 8
    states = np.frombuffer(block, "<u8", segments * LANES, at).reshape(segments, LANES)
    at += segments * LANES * 8
    starts = np.concatenate([[0], np.cumsum(checks[:, 0], dtype=np.int64)])
    last = segments if last is None else min(last, segments)
    stream = np.frombuffer(block, "<u4", int(starts[-1]), at)
    for k in range(first, last):
        if zlib.crc32(states[k].tobytes() + stream[starts[k] : starts[k + 1]].tobytes()) != checks[k, 1]:
            raise ValueError(f"segment {k} is damaged")
    stream = np.append(stream, np.uint32(0)).astype(np.uint64)
    place, state = starts[first:last].copy(), states[first:last].astype(np.uint64)
    out = np.empty((max(0, last - first), STEPS, LANES), np.uint32)
    mask, scale, shift = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
    for step in range(STEPS if len(out) else 0):
        slot = state & mask
        symbol = table.symbol[slot]
        out[:, step] = symbol
        state = table.freq[symbol] * (state >> scale) + slot - table.cum[symbol]
        low = state < LOW
        rank = low.cumsum(axis=1)
        state = np.where(low, (state << shift) | stream[np.minimum(place[:, None] + rank - 1, len(stream) - 1)], state)
        place += rank[:, -1]
    return doc_ids, lengths, out.reshape(-1)[: max(0, min(n, last * SEGMENT) - first * SEGMENT)]
