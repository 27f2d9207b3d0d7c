"""Token ids of whole texts, with a bounded memory of words met before.

The byte-level split never joins what stands before a space that a visible character follows, nor a lone line end to
its neighbours, nor a letter to a mark after it. So a text may be cut there and its words be encoded by themselves; a
batch's distinct words are found in Arrow, and those that were met before by two 64-bit hashes. Every new word goes
through the tokenizers library. A text with any other white space, or with a special token of the tokenizer, is not cut: the library
encodes it whole, and gives a special token its own id, as in any call of its own.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from evidentia.llm.common import owns

#: Words remembered by one worker; beyond it new words are encoded whenever they come.
REMEMBERED = 1_200_000
#: Bytes of the texts that are encoded at once; a longer text is by itself.
AT_ONCE = 1 << 22
#: Bytes of the longest word that is remembered.
LONGEST = 1 << 12
#: A word that ends in one of these after a letter is its stem and the mark.
MARKS = ".,;:!?"
#: White space that is not one space or line end between visible characters (RE2).
_ODD = r"[\t\x0b\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[ \n][ \n]|\A[ \n]|[ \n]\z|\A\z"
_LOADED: dict[str, IdEncoder] = {}
owns("token_ids", _LOADED.clear)


_FACTORS = np.random.default_rng(7).integers(0, 1 << 63, (2, LONGEST), np.uint64) * np.uint64(2) + np.uint64(1)


def _hashes(words: pa.StringArray) -> np.ndarray:
    """Two 64-bit hashes of each word, none of which is empty: sums of its bytes times odd factors by place."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    starts, sizes = ends[:-1] - ends[0], np.diff(ends)
    place = np.minimum(np.arange(ends[-1] - ends[0]) - np.repeat(starts, sizes), LONGEST - 1)
    values = np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]].astype(np.uint64) + np.uint64(1)
    return np.stack([np.add.reduceat(f[place] * values, starts) for f in _FACTORS])


class _Table:
    """Places by the two hashes of a word, by open addressing in flat arrays."""

    def __init__(self, most: int):
        bits = max(4, (3 * most).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.first, self.second, self.place = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)

    def _slot(self, first: np.ndarray) -> np.ndarray:
        return ((first ^ (first >> np.uint64(32))) & self.mask).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the words; -1 for those that are not held."""
        out, open_ = np.full(hashes.shape[1], -1, np.int64), np.arange(hashes.shape[1])
        slot = self._slot(hashes[0])
        while len(open_):
            place = self.place[slot]
            same = (place >= 0) & (self.first[slot] == hashes[0, open_]) & (self.second[slot] == hashes[1, open_])
            out[open_[same]] = place[same]
            on = (place >= 0) & ~same
            open_, slot = open_[on], (slot[on] + 1) & int(self.mask)
        return out

    def add(self, hashes: np.ndarray, places: np.ndarray) -> None:
        """Hold words that are not held yet."""
        open_, slot = np.arange(len(places)), self._slot(hashes[0])
        while len(open_):
            free = np.flatnonzero(self.place[slot] < 0)
            taken, first = np.unique(slot[free], return_index=True)
            now = free[first]
            self.first[taken], self.second[taken], self.place[taken] = hashes[0, open_[now]], hashes[1, open_[now]], places[open_[now]]
            on = np.ones(len(open_), bool)
            on[now] = False
            open_, slot = open_[on], (slot[on] + 1) & int(self.mask)


def grouped(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Batches joined up to AT_ONCE bytes of their text column: the larger, the fewer distinct words a text."""
    held, size = [], 0
    for batch in batches:
        more = pc.sum(pc.binary_length(batch.column(text))).as_py() or 0
        if held and size + more > AT_ONCE:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        if batch.num_rows:
            held.append(batch)
            size += more
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class IdEncoder:
    """Texts to little-endian unsigned 32-bit ids, none added."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.remembered = remembered
        #: A word's place in starts and sizes, which say where its ids stand in the pool; what is beyond the words' number is overwritten.
        self.table, self.known = _Table(remembered), 0
        self.starts, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.pool, self.used = np.zeros(1 << 18, "<u4"), 0
        #: Ids whose first byte is a space or a line end, which the vocabulary writes as U+0120 and U+010A.
        self.opens = np.zeros(self.vocabulary, bool)
        self.opens[[i for token, i in self.tokenizer.get_vocab().items() if token[0] in "ĠĊ"]] = True
        self.marks = {m: int(ids[0]) for m, ids in zip(MARKS, self._whole(list(MARKS)), strict=True)}

    @classmethod
    def shared(cls, path: str) -> IdEncoder:
        """One encoder for a worker process."""
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size()

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _gathered(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The pool's ids of these stretches, one after another."""
        ends = np.cumsum(sizes)
        return self.pool[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]

    def _put(self, at: int, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Ids of the words from place `at` on."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while at + len(sizes) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        self.pool[self.used : self.used + len(ids)] = ids
        self.starts[at : at + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[at : at + len(sizes)] = sizes
        self.used += len(ids)

    def _learn(self, words: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Places of new words, as they stand after a space, or after what precedes their line end; and new stems with theirs.

        They go as one text, which is cut where ids begin with a space or line end.
        """
        marked = [w[-1] in MARKS and len(w) > 1 and w[-2].isalpha() for w in words]
        stems = [w[:-1] for w, m in zip(words, marked, strict=True) if m]
        distinct = list(dict.fromkeys(stems))
        at = self.table.find(_hashes(pa.array(distinct, pa.string()))) if distinct else np.zeros(0, np.int64)
        new = dict.fromkeys([w for w, m in zip(words, marked, strict=True) if not m])
        own = [w for w, place in zip(distinct, at.tolist(), strict=True) if place < 0 and w not in new]
        bare = [*new, *own]
        place = dict(zip(bare, range(self.known, self.known + len(bare)), strict=True))
        if bare:
            ids = self._whole(["".join([w if w[0] == "\n" else " " + w for w in bare])])[0]
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) != len(bare):
                raise ValueError("words and their ids differ")
            self._put(self.known, ids, np.diff(np.append(starts, len(ids))))
        out = np.zeros(len(words), np.int64)
        is_marked = np.array(marked, bool)
        out[~is_marked] = np.arange(self.known, self.known + len(new))
        if stems:
            held = dict(zip(distinct, at.tolist(), strict=True))
            of = np.array([place[w] if w in place else held[w] for w in stems], np.int64)
            sizes = self.sizes[of] + 1
            ids = np.zeros(int(sizes.sum()), "<u4")
            last = np.zeros(len(ids), bool)
            last[np.cumsum(sizes) - 1] = True
            ids[~last] = self._gathered(self.starts[of], self.sizes[of])
            ids[last] = [self.marks[w[-1]] for w, m in zip(words, marked, strict=True) if m]
            first = self.known + len(bare)
            self._put(first, ids, sizes)
            out[is_marked] = np.arange(first, first + len(stems))
        return out, own, np.arange(self.known + len(new), self.known + len(bare))

    def _cut(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of texts that may be cut."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        ends = np.cumsum(pc.list_value_length(lists).to_numpy())
        words = lists.flatten().dictionary_encode()
        distinct, index = words.dictionary, words.indices.to_numpy()
        begins = np.append(0, ends[:-1])
        heads = self._whole(distinct.take(pa.array(index[begins])).to_pylist())
        hashes, used = _hashes(distinct), self.used
        places = self.table.find(hashes)
        unseen = np.flatnonzero(places < 0)
        stems: list[str] = []
        if len(unseen):
            places[unseen], stems, stem_places = self._learn(distinct.take(pa.array(unseen)).to_pylist())
        at = places[index]
        starts, sizes = self.starts[at], self.sizes[at]
        sizes[begins] = 0
        ids, stops = self._gathered(starts, sizes).tobytes(), (4 * np.cumsum(sizes)[ends - 1]).tolist()
        if not len(unseen):
            pass
        elif self.known + len(unseen) + len(stems) <= self.remembered:
            short = unseen[pc.binary_length(distinct).to_numpy()[unseen] <= LONGEST]
            self.table.add(hashes[:, short], places[short])
            if kept := [k for k, w in enumerate(stems) if len(w.encode()) <= LONGEST]:
                self.table.add(_hashes(pa.array([stems[k] for k in kept], pa.string())), stem_places[kept])
            self.known += len(unseen) + len(stems)
        else:
            self.used = used
        for head, start, stop in zip(heads, [0, *stops[:-1]], stops, strict=True):
            yield head.tobytes() + ids[start:stop]

    def encode(self, texts: list[str] | pa.Array) -> Iterator[bytes]:
        """The ids of each text, in order."""
        column = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        odd = pc.match_substring_regex(column, _ODD)
        for token in self.special:
            odd = pc.or_(odd, pc.match_substring(column, token))
        odd, sizes = odd.to_numpy(zero_copy_only=False), pc.binary_length(column).to_numpy()
        start = 0
        while start < len(column):
            end, size = start + 1, int(sizes[start])
            while end < len(column) and odd[end] == odd[start] and size + sizes[end] <= AT_ONCE:
                size += int(sizes[end])
                end += 1
            part = column.slice(start, end - start)
            yield from (ids.tobytes() for ids in self._whole(part.to_pylist())) if odd[start] else self._cut(part)
            start = end
