"""LM scoring: a two-word model over all training texts, held in sharded Elias-Fano tries.

Tokens are the words of a text, lower-cased in A-Z, then END. A pair's probability is smoothed by a Dirichlet prior:
(uses of the pair + MU * p1) / (uses of the first + MU), where p1 = (c + 1) / (N + V + 1) is the base probability. The
tries hold the probabilities of the pairs met in training, and of each context the weight MU / (uses + MU) by which any
other pair backs off to p1; both are quantised to steps of 0.00025 in log10. Null text counts as empty and has END alone.
Rows that share a doc_id are scored by themselves; a null doc_id is never held out. Without any training row N and V are
0. Other columns are not read. An empty table gives no rows.

Texts are read in chunks, named by their place. A chunk sends each distinct token once, with its uses in training rows,
to the shard that its hash names, and gets back the token's uses in all. It then sends its distinct pairs to the shards
of their contexts; a context used more than HOT times has several, dealt by the second word. A shard adds up the chunks,
builds its trie in a memory map, and answers every chunk in the chunk's own order; chunk and answers meet again and each
document is scored. A frequent word or pair is one entry a chunk. Shards grow in number with the input; nothing that
grows with it is broadcast. A chunk's rows are at most its entries, however many shards there are.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import Names, alone, bounded_batches, drop_tables, fold_of, owns, scratch_table, spread, table_bytes, text_or_empty
from evidentia.llm.ngram_trie import Trie, log10_of, quantise

END, BEGIN = 1, 2
MU = 20.0
#: Tokens of a chunk, bytes of the table, as its files tell, that one shard should serve, and uses of a context that fill one.
CHUNK = 1 << 20
SHARD_BYTES = 6 << 20
HOT = 1 << 20
_NULL = -(1 << 63)
_ROW = "kind int, shard int, chunk long, a binary, b binary, c binary, d binary"
_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
PAIRS, TOKENS, TEXTS, TOTALS = 0, 1, 2, 3
_NAMES = Names(xxhash.xxh64_intdigest)
owns("lm", _NAMES.clear)


def _packed(x: np.ndarray, kind: str) -> bytes:
    """Numbers by planes of their bytes, as the upper ones are mostly alike and so compress."""
    return np.ascontiguousarray(x.astype(kind).view(np.uint8).reshape(len(x), -1).T).tobytes()


def _unpacked(raw: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def _mixed(x: np.ndarray, y: np.ndarray | None = None) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    if y is not None:
        x = (x ^ (x >> np.uint64(29))) + y * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x >> np.uint64(33)


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Shards in order with the places of what goes there."""
    order = np.argsort(shard, kind="stable")
    some, starts = np.unique(shard[order], return_index=True)
    yield from zip(some.tolist(), np.split(order, starts[1:]), strict=True)


class _Pairs:
    """The distinct pairs of a chunk, by (context, word) in its names; the last context is the beginning of a text."""

    def __init__(self, names: np.ndarray, token: np.ndarray, sizes: np.ndarray):
        begin = len(names)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        before = np.concatenate([[begin], token[:-1]])
        before[starts] = begin
        keys, self.pair = np.unique(before * (begin + 1) + token, return_inverse=True)
        self.first, self.second = keys // (begin + 1), keys % (begin + 1)
        self.first_name, self.second_name = np.append(names, np.uint64(BEGIN))[self.first], names[self.second]

    def sent(self, counts: np.ndarray, shards: int, hot: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per shard: places of its pairs, and where runs of a context begin and how long they are."""
        parts = (counts[self.first] // hot + 1).astype(np.uint64)
        shard = _mixed(self.first_name, _mixed(self.second_name) % parts) % np.uint64(shards)
        for k, at in _by_shard(shard.astype(np.int64)):
            runs = np.flatnonzero(np.concatenate([[True], self.first[at][1:] != self.first[at][:-1]]))
            yield k, at, runs, np.diff(np.append(runs, len(at)))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
    rows = [(*row, *[None] * (len(types) - len(row))) for row in rows]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[x.split()[0] for x in _ROW.split(", ")])


def _chunked(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """A text row for each chunk of a partition: distinct names, each token's place among them, ids and lengths."""
    alone("lm")
    doc_ids: list[int] = []
    lengths: list[int] = []
    tokens: list[np.ndarray] = []
    size = number = 0
    part = TaskContext.get().partitionId()

    def row() -> pa.RecordBatch:
        nonlocal number
        ids, sizes = np.array(doc_ids, np.int64), np.array(lengths, np.int64)
        names, token = np.unique(np.concatenate(tokens), return_inverse=True)
        name, number = part << 32 | number, number + 1
        return _batch([(TEXTS, -1, name, names.tobytes(), _packed(token, "<u4"), _packed(np.concatenate([ids, sizes]), "<i8"))])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = text.encode("utf-8", "surrogatepass").lower().split()
            doc_ids.append(_NULL if doc_id is None else doc_id)
            lengths.append(len(words) + 1)
            tokens.append(np.append(np.fromiter(map(_NAMES.__getitem__, words), np.uint64, len(words)), np.uint64(END)))
            size += len(words) + 1
            if size >= chunk:
                yield row()
                doc_ids, lengths, tokens, size = [], [], [], 0
    if doc_ids:
        yield row()


def _text(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names, token places, ids and lengths of a text row."""
    ids, sizes = _unpacked(row["c"], "<i8").reshape(2, -1)
    return np.frombuffer(row["a"], "<u8"), _unpacked(row["b"], "<u4").astype(np.int64), ids, sizes


def _trained(ids: np.ndarray, sizes: np.ndarray, folds: int, fold: int) -> np.ndarray:
    """Which tokens stand in training rows."""
    return np.repeat([i == _NULL or fold_of(i, folds) != fold for i in ids.tolist()], sizes)


def _asked_tokens(batches: Iterator[pa.RecordBatch], shards: int, folds: int, fold: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            names, token, ids, sizes = _text(row)
            uses = np.bincount(token[_trained(ids, sizes, folds, fold)], minlength=len(names))
            yield _batch([(TOKENS, k, row["chunk"], names[at].tobytes(), _packed(uses[at], "<u4")) for k, at in _by_shard((_mixed(names) % np.uint64(shards)).astype(np.int64))])


def _joined(rows: list[dict], column: str, kind: str) -> np.ndarray:
    return np.concatenate([_unpacked(r[column], kind) for r in rows])


def _names(rows: list[dict], column: str) -> np.ndarray:
    return np.frombuffer(b"".join(r[column] for r in rows), "<u8")


def _rows(batches: Iterator[pa.RecordBatch]) -> list[dict]:
    """All rows of a partition, which is one shard's."""
    return [row for batch in batches for row in batch.to_pylist()]


def _answered_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if rows := _rows(batches):
        distinct, place = np.unique(_names(rows, "a"), return_inverse=True)
        totals = np.bincount(place, _joined(rows, "b", "<u4"), len(distinct)).astype("<i8")
        answer, at, out = totals[place], 0, []
        for r in rows:
            n = len(r["a"]) // 8
            out.append((TOKENS, r["shard"], r["chunk"], _packed(answer[at : at + n], "<i8")))
            at += n
        sums = np.array([totals.sum(), (totals > 0).sum()], "<i8")
        yield _batch([*out, (TOTALS, rows[0]["shard"], 0, sums.tobytes())])


def _with_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[dict]]]:
    """Text rows with the answers to their chunk; rows are sorted by chunk, answers by shard before the text."""
    answers: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if answers and answers[0]["chunk"] != row["chunk"]:
                answers = []
            if row["kind"] != TEXTS:
                answers.append(row)
                continue
            yield row, answers
            answers = []


def _counted(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Text rows with the uses of their names in all training rows."""
    for row, answers in _with_answers(batches):
        names = np.frombuffer(row["a"], "<u8")
        counts = np.zeros(len(names), "<i8")
        counts[np.concatenate([at for _, at in _by_shard((_mixed(names) % np.uint64(shards)).astype(np.int64))])] = _joined(answers, "a", "<i8")
        yield _batch([(TEXTS, -1, row["chunk"], row["a"], row["b"], row["c"], _packed(counts, "<i8"))])


def _asked_pairs(batches: Iterator[pa.RecordBatch], shards: int, folds: int, fold: int, total: int, distinct: int, documents: int, hot: int) -> Iterator[pa.RecordBatch]:
    """Contexts with the length of their run and their uses; words; and the pairs' uses and codes of the words' p1."""
    for batch in batches:
        for row in batch.to_pylist():
            names, token, ids, sizes = _text(row)
            counts = np.append(_unpacked(row["d"], "<i8"), documents)
            pairs = _Pairs(names, token, sizes)
            uses = np.bincount(pairs.pair[_trained(ids, sizes, folds, fold)], minlength=len(pairs.first))
            p1 = quantise((counts + 1) / (total + (distinct + 1)))[pairs.second]
            out = []
            for k, at, runs, lengths in pairs.sent(counts, shards, hot):
                heads = at[runs]
                a = pairs.first_name[heads].tobytes() + _packed(counts[pairs.first[heads]], "<i8") + _packed(lengths, "<u4")
                out.append((PAIRS, k, row["chunk"], a, pairs.second_name[at].tobytes(), _packed(uses[at], "<u4"), _packed(p1[at], "<u2")))
            yield _batch(out)


def _answered_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if not (rows := _rows(batches)):
        return
    runs = [len(r["a"]) // 20 for r in rows]
    first = np.concatenate([np.frombuffer(r["a"], "<u8", n) for r, n in zip(rows, runs, strict=True)])
    used = np.concatenate([_unpacked(r["a"][8 * n : 16 * n], "<i8") for r, n in zip(rows, runs, strict=True)])
    lengths = np.concatenate([_unpacked(r["a"][16 * n :], "<u4") for r, n in zip(rows, runs, strict=True)]).astype(np.int64)
    contexts, some, context = np.unique(first, return_index=True, return_inverse=True)
    used = used[some]
    words, word = np.unique(_names(rows, "b"), return_inverse=True)
    key, some, pair = np.unique(np.repeat(context, lengths) * len(words) + word, return_index=True, return_inverse=True)
    uses = np.bincount(pair, _joined(rows, "c", "<u4"), len(key))
    of, to = key // len(words), key % len(words)
    met = np.flatnonzero(uses)
    p = (uses[met] + MU * 10 ** log10_of(_joined(rows, "d", "<u2")[some[met]])) / (used[of[met]] + MU)
    known, kept = np.flatnonzero(used), np.unique(to[met])
    trie = Trie.of(contexts[known], MU / (used[known] + MU), words[kept], np.searchsorted(known, of[met]), np.searchsorted(kept, to[met]), p).to_bytes()
    with mmap.mmap(-1, len(trie)) as held:
        held.write(trie)
        mapped = Trie.mapped(held)
        codes, weights = mapped.lookup(contexts[of], words[to])[pair], mapped.backoff(contexts)[context]
        del mapped
    at, run, out = 0, 0, []
    for r, m in zip(rows, runs, strict=True):
        n = len(r["b"]) // 8
        out.append((PAIRS, r["shard"], r["chunk"], _packed(codes[at : at + n], "<u2"), _packed(weights[run : run + m], "<u2")))
        at, run = at + n, run + m
    yield _batch(out)


def _scored(batches: Iterator[pa.RecordBatch], shards: int, folds: int, fold: int, total: int, distinct: int, documents: int, hot: int) -> Iterator[pa.RecordBatch]:
    for row, answers in _with_answers(batches):
        names, token, ids, sizes = _text(row)
        counts = np.append(_unpacked(row["d"], "<i8"), documents)
        pairs = _Pairs(names, token, sizes)
        codes, weights = np.zeros(len(pairs.first), np.uint16), np.zeros(len(counts), np.uint16)
        sent = [*pairs.sent(counts, shards, hot)]
        codes[np.concatenate([at for _, at, _, _ in sent])] = _joined(answers, "a", "<u2")
        weights[np.concatenate([pairs.first[at[runs]] for _, at, runs, _ in sent])] = _joined(answers, "b", "<u2")
        p1 = np.log10((counts[:-1] + 1) / (total + (distinct + 1)))
        away = np.where(weights > 0, log10_of(weights), 0.0)[pairs.first] + p1[pairs.second]
        scores = np.where(codes > 0, log10_of(codes), away)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        sums = lambda x, starts=starts: np.add.reduceat(x, starts)
        columns = [
            pa.array([None if i == _NULL else i for i in ids.tolist()], pa.int64()),
            pa.array([i != _NULL and fold_of(i, folds) == fold for i in ids.tolist()], pa.bool_()),
            pa.array(sizes, pa.int64()),
            pa.array(sums((counts > 0)[token].astype(np.int64)), pa.int64()),
            pa.array(np.full(len(ids), total, np.int64)),
            pa.array(sums(p1[token])),
            pa.array(sums(scores[pairs.pair])),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _SCORED.split(", ")])


def score(docs: DataFrame, folds: int = 7, fold: int = 2, chunk: int = CHUNK, hot: int = HOT) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; rows of the fold teach nothing."""
    spark = docs.sparkSession
    bounded_batches(spark)
    slim = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    shards = spread(spark, table_bytes(docs), SHARD_BYTES)

    def answered(rows: DataFrame, answer) -> DataFrame:
        return rows.repartitionById(shards, "shard").sortWithinPartitions("chunk").mapInArrow(answer, _ROW)

    texts = scratch_table(slim.mapInArrow(lambda b: _chunked(b, chunk), _ROW), "lm-texts")
    parts = 1 + (texts.agg(F.max(F.shiftright("chunk", 32))).first()[0] or 0)

    def together(rows: DataFrame, answers: DataFrame) -> DataFrame:
        order = F.when(F.col("kind") == TEXTS, 1 << 30).otherwise(F.col("shard"))
        return rows.unionByName(answers).repartitionById(parts, F.shiftright("chunk", 32).cast("int")).sortWithinPartitions("chunk", order)

    tokens = scratch_table(answered(texts.mapInArrow(lambda b: _asked_tokens(b, shards, folds, fold), _ROW), _answered_tokens), "lm-tokens")
    sums = [np.frombuffer(bytes(r.a), "<i8") for r in tokens.filter(F.col("kind") == TOTALS).select("a").collect()]
    total, distinct = (int(sum(s[k] for s in sums)) for k in (0, 1))
    trained = F.col("doc_id").isNull() | (F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != fold)
    documents = slim.filter(trained).count()
    counted = scratch_table(together(texts, tokens.filter(F.col("kind") == TOKENS)).mapInArrow(lambda b: _counted(b, shards), _ROW), "lm-counted", large=True)
    drop_tables(texts, tokens)
    asked = counted.mapInArrow(lambda b: _asked_pairs(b, shards, folds, fold, total, distinct, documents, hot), _ROW)
    pairs = scratch_table(answered(asked, _answered_pairs), "lm-pairs", large=True)
    return together(counted, pairs).mapInArrow(lambda b: _scored(b, shards, folds, fold, total, distinct, documents, hot), _SCORED)
