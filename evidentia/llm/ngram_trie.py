"""A model of one and two words as a trie with Elias-Fano sequences, kept in one buffer that can be memory-mapped.

Level 1 has the contexts, a monotone sequence of 64-bit names, each with its back-off weight. Level 2 has, for each
context, the words that follow it, as ranks in the trie's vocabulary (another monotone sequence of names). A context's
range in level 2 comes from a monotone sequence of pointers. Level 2 is itself monotone, as context k's ranks are raised
by k times the vocabulary, so a word is sought as the successor of its rank relative to the context. Values are smoothed
probabilities and back-off weights, quantised to 16 bits by their logarithm.
"""

from __future__ import annotations

import numpy as np

#: Codes are steps of log10 from 0 down to LEAST; code 0 is for what is absent.
LEAST = -16.0
_CODES = (1 << 16) - 2


def quantise(p: np.ndarray) -> np.ndarray:
    """Codes from 1 of probabilities or weights: the nearest step of their logarithm."""
    return (1 + np.rint(np.clip(np.log10(p) / LEAST, 0.0, 1.0) * _CODES)).astype(np.uint16)


def log10_of(codes: np.ndarray) -> np.ndarray:
    """The logarithms of codes from 1."""
    return (codes.astype(np.float64) - 1) * (LEAST / _CODES)


class EliasFano:
    """A monotone sequence: low bits packed, high bits in unary, with counts of ones before each word."""

    def __init__(self, head: np.ndarray, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.head, self.low, self.high, self.ones = head, low, high, ones
        self.n, self.bits = int(head[0]), int(head[1])
        self.zeros = np.arange(len(high), dtype=np.int64) * 64 - ones

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        bits = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        values = values.astype(np.uint64)
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits and n:
            at = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            part = values & np.uint64((1 << bits) - 1)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))  # places share words in runs
            low[word[first]] = np.bitwise_or.reduceat(part << shift, first)
            over = np.flatnonzero(shift + np.uint64(bits) > 64)
            low[word[over] + 1] |= part[over] >> (np.uint64(64) - shift[over])
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(((universe >> bits) + n + 64) // 64 + 1, np.uint64)
        if n:
            word = places >> 6
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            high[word[first]] = np.bitwise_or.reduceat(np.uint64(1) << (places & 63).astype(np.uint64), first)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)[:-1]])
        return cls(np.array([n, bits], np.int64), low, high, ones)

    def parts(self) -> list[np.ndarray]:
        return [self.head, self.low, self.high, self.ones]

    def _select(self, before: np.ndarray, words: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Place of the k-th set bit of words, from how many are set before each."""
        at = np.searchsorted(before, k, side="right") - 1
        word, left = words[at], (k - before[at]).astype(np.int64)
        place = np.zeros(len(k), np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            inside = np.bitwise_count((word >> place.astype(np.uint64)) & np.uint64((1 << step) - 1)).astype(np.int64)
            skip = inside <= left
            left -= np.where(skip, inside, 0)
            place += np.where(skip, step, 0)
        return at * 64 + place

    def _low(self, k: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(k), np.uint64)
        at = k.astype(np.uint64) * np.uint64(self.bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        upper = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> shift) | upper) & np.uint64((1 << self.bits) - 1)

    def get(self, k: np.ndarray) -> np.ndarray:
        """Values at places k."""
        high = self._select(self.ones, self.high, k) - k
        return (high.astype(np.uint64) << np.uint64(self.bits)) | self._low(k)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first value that is x or more; n where there is none."""
        x = x.astype(np.uint64)
        high, low = (x >> np.uint64(self.bits)).astype(np.int64), x & np.uint64((1 << self.bits) - 1)
        start = np.where(high > 0, self._select(self.zeros, ~self.high, np.maximum(high - 1, 0)) + 1 - high, 0)
        end = self._select(self.zeros, ~self.high, high) - high
        while (open_ := np.flatnonzero(start < end)).size:
            middle = (start[open_] + end[open_]) // 2
            less = self._low(middle) < low[open_]
            start[open_] = np.where(less, middle + 1, start[open_])
            end[open_] = np.where(less, end[open_], middle)
        return start


class Trie:
    def __init__(self, words: EliasFano, contexts: EliasFano, weights: np.ndarray, pointers: EliasFano, followers: EliasFano, codes: np.ndarray):
        self.words, self.contexts, self.weights, self.pointers, self.followers, self.codes = words, contexts, weights, pointers, followers, codes

    @classmethod
    def of(cls, contexts: np.ndarray, weights: np.ndarray, words: np.ndarray, context: np.ndarray, word: np.ndarray, p: np.ndarray) -> Trie:
        """From sorted names of contexts with their back-off weights, sorted names of words, and the pairs, sorted, by places in these with their probabilities."""
        size = max(1, len(words))
        starts = np.searchsorted(context, np.arange(len(contexts) + 1))
        followers = EliasFano.of(context.astype(np.int64) * size + word, max(1, len(contexts) * size))
        return cls(EliasFano.of(words, 1 << 64), EliasFano.of(contexts, 1 << 64), quantise(weights), EliasFano.of(starts, len(context) + 1), followers, quantise(p))

    def to_bytes(self) -> bytes:
        """All levels in one buffer: a table of sizes, then the arrays."""
        parts = [*self.words.parts(), *self.contexts.parts(), self.weights, *self.pointers.parts(), *self.followers.parts(), self.codes]
        return b"".join([np.array([p.nbytes for p in parts], "<i8").tobytes(), *(p.tobytes() + bytes(-p.nbytes % 8) for p in parts)])

    @classmethod
    def mapped(cls, buffer) -> Trie:
        """The levels as views of a buffer or memory map."""
        raw = np.frombuffer(buffer, np.uint8)
        sequence = [np.int64, np.uint64, np.uint64, np.int64]
        kinds = [*sequence, *sequence, np.uint16, *sequence, *sequence, np.uint16]
        at, parts = 8 * len(kinds), []
        for size, kind in zip(raw[:at].view("<i8").tolist(), kinds, strict=True):
            parts.append(raw[at : at + size].view(kind))
            at += size + -size % 8
        return cls(EliasFano(*parts[:4]), EliasFano(*parts[4:8]), parts[8], EliasFano(*parts[9:13]), EliasFano(*parts[13:17]), parts[17])

    @staticmethod
    def _rank(sequence: EliasFano, names: np.ndarray) -> np.ndarray:
        """Places of names in a level; -1 for what it has not."""
        out = np.full(len(names), -1, np.int64)
        at = sequence.successor(names)
        inside = np.flatnonzero(at < sequence.n)
        same = inside[sequence.get(at[inside]) == names[inside]]
        out[same] = at[same]
        return out

    def backoff(self, contexts: np.ndarray) -> np.ndarray:
        """Codes of the contexts' back-off weights; 0 for those that the trie has not."""
        out, at = np.zeros(len(contexts), np.uint16), self._rank(self.contexts, contexts)
        out[at >= 0] = self.weights[at[at >= 0]]
        return out

    def lookup(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Codes of the probabilities of pairs of names; 0 for those that the trie has not."""
        out = np.zeros(len(words), np.uint16)
        if not len(self.codes):
            return out
        head, rank = self._rank(self.contexts, contexts), self._rank(self.words, words)
        some = np.flatnonzero((head >= 0) & (rank >= 0))
        sought = head[some] * self.words.n + rank[some]
        at = self.followers.successor(sought)
        inside = at < self.pointers.get(head[some] + 1).astype(np.int64)
        some, sought, at = some[inside], sought[inside], at[inside]
        same = self.followers.get(at).astype(np.int64) == sought
        out[some[same]] = self.codes[at[same]]
        return out
