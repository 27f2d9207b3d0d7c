"""Language ID: an interpolated Kneser-Ney model of characters per language; the lowest cross-entropy per symbol wins.

Words are runs of letters (Unicode category L), in lower case, each with a mark before and after; a model never looks
across words, so words met before are looked up. All models share sorted arrays of n-gram hashes with a column per
language; an n-gram that is in the arrays has its interpolated probability there, any other the weight of its context
times that of its suffix. Models learn from a bounded sample of labelled rows: about SAMPLE_DOCS of each language, picked
by hash, of each its first SAMPLE_CHARS characters. Of a language's rows one in CALIBRATION is kept out (none of a single
one) to fit the score (a logistic curve over the margin to the runner-up) and the cross-entropy above which a text is
rejected: as far above the QUANTILE of the language's own as that is above their middle, and as far as for all languages
together where it has under FEW.

A null text or one without a letter is `und`, score 0, rejected. Null labels teach nothing. Where no row is labelled all
texts are `und`. Ties go to the language that sorts first. Each row gives one row. Predictions read whole texts.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidentia.llm.common import alone, bounded_batches, trim

ORDER = 4
SAMPLE_DOCS = 2000
SAMPLE_CHARS = 20_000
CALIBRATION = 5
QUANTILE, FEW = 0.99, 5
UND = "und"
#: Short texts vary more: the rejection limit is higher by so many bits over the root of their symbols.
SLACK = 12.0
_START, _END = 2, 3
_WORDS = regex.compile(r"\p{L}+")
#: Tokens and characters remembered by one worker.
REMEMBERED, REMEMBERED_CHARS = 400_000, 16_000_000
#: Tokens of a batch that are summed up at once.
_AT_ONCE = 1 << 18


def _spelt(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, each behind ORDER - 1 start marks and before an end mark; and where words end."""
    pad = chr(_START) * (ORDER - 1)
    text = "".join([pad + w + chr(_END) for w in words])
    ends = np.cumsum(np.fromiter((len(w) + ORDER for w in words), np.int64, len(words)))
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64), ends


def _hashes(codes: np.ndarray) -> list[np.ndarray]:
    """Per order from 0 to ORDER, the hash of the n-gram that ends at each place (places before ORDER - 1 are void)."""
    out = [np.zeros(len(codes), np.uint64)]
    mixed = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    for k in range(1, ORDER + 1):
        back = np.concatenate([np.zeros(k - 1, np.uint64), mixed[: len(codes) - k + 1]])
        out.append((out[-1] * np.uint64(0xBF58476D1CE4E5B9)) + back * np.uint64(2 * k + 1) + np.uint64(k))
    return out


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Rows of the keys in a sorted table; its length where absent."""
    at = np.searchsorted(table, keys)
    return np.where((at < len(table)) & (table[np.minimum(at, len(table) - 1)] == keys), at, len(table)) if len(table) else np.zeros(len(keys), np.int64)


@dataclass
class Models:
    """Per order: sorted n-gram hashes with the log2 of their interpolated probabilities, sorted context hashes with the
    log2 of the weight they leave to the lower order; a column per language and a last row for what is absent."""

    langs: list[str]
    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    floor: float
    slope: float
    offset: float
    limits: np.ndarray

    def log_probabilities(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """log2 probability of each word by language, and its symbols."""
        codes, ends = _spelt(words)
        hashes = _hashes(codes)
        starts = np.concatenate([[0], ends[:-1]])
        at = _symbols(len(codes), starts)
        out = np.zeros((len(at), len(self.langs)))
        open_ = np.arange(len(at))
        for k in range(ORDER, 0, -1):
            place = at[open_]
            row = _find(self.grams[k], hashes[k][place])
            met = row < len(self.grams[k])
            out[open_[met]] += self.logs[k][row[met]]
            open_, place = open_[~met], place[~met]
            out[open_] += self.weights[k][_find(self.contexts[k], hashes[k - 1][place - 1])]
        out[open_] += np.log2(self.floor)
        sizes = ends - starts - (ORDER - 1)
        return np.add.reduceat(out, np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0), sizes.astype(np.float64)


def _symbols(n: int, starts: np.ndarray) -> np.ndarray:
    """Places of what is predicted: all but the start marks."""
    place = np.ones(n, bool)
    for k in range(ORDER - 1):
        place[starts + k] = False
    return np.flatnonzero(place)


class _Tally:
    """Kneser-Ney statistics of one language: per order the n-grams, their counts, contexts and suffixes."""

    def __init__(self, words: dict[str, int]):
        spelt, uses = list(words), np.fromiter(words.values(), np.int64, len(words))
        codes, ends = _spelt(spelt)
        hashes = _hashes(codes)
        starts = np.concatenate([[0], ends[:-1]])
        whole = _symbols(len(codes), starts)
        counts = np.repeat(uses, ends - starts - (ORDER - 1))
        self.orders = {}
        for k in range(ORDER, 0, -1):
            grams, first, inverse = np.unique(hashes[k][whole], return_index=True, return_inverse=True)
            n = np.bincount(inverse, counts, len(grams))
            where = whole[first]
            self.orders[k] = (grams, n, hashes[k - 1][where - 1], hashes[k - 1][where])
            counts, whole = np.ones(len(where), np.int64), where  # each distinct n-gram continues its suffix once


def _fit_counts(samples: dict[str, dict[str, int]]) -> Models:
    langs = sorted(samples)
    if not langs:
        return Models([], [], [], [], [], 1.0, 1.0, 0.0, np.zeros(0))
    tallies = [_Tally(samples[lang]) for lang in langs]
    floor = 1.0 / (max(len(t.orders[1][0]) for t in tallies) + 257)
    none = np.zeros(0, np.uint64)
    grams, logs, contexts, weights = [none], [np.zeros((1, len(langs)))], [none], [np.zeros((1, len(langs)))]
    lower = np.full((1, len(langs)), floor)  # of the order below, the last row for what it has not
    for k in range(1, ORDER + 1):
        keys, at = np.unique(np.concatenate([t.orders[k][0] for t in tallies]), return_index=True)
        heads, tails = (np.concatenate([t.orders[k][c] for t in tallies])[at] for c in (2, 3))
        all_contexts = np.unique(heads)
        share, weight = np.zeros((len(keys), len(langs))), np.ones((len(all_contexts) + 1, len(langs)))
        for column, tally in enumerate(tallies):
            own, n, context, _ = tally.orders[k]
            ones, twos = int((n == 1).sum()), int((n == 2).sum())
            discount = min(0.9, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
            met, inverse = np.unique(context, return_inverse=True)
            total, kinds = np.bincount(inverse, n), np.bincount(inverse)
            share[np.searchsorted(keys, own), column] = np.maximum(n - discount, 0) / total[inverse]
            weight[np.searchsorted(all_contexts, met), column] = discount * kinds / total
        suffix = _find(grams[-1], tails) if k > 1 else np.zeros(len(keys), np.int64)
        p = share + weight[np.searchsorted(all_contexts, heads)] * lower[suffix]
        grams.append(keys)
        logs.append(np.log2(p))
        contexts.append(all_contexts)
        weights.append(np.log2(weight))
        lower = p
    return Models(langs, grams, logs, contexts, weights, floor, 1.0, 0.0, np.full(len(langs), np.inf))


def _words(text: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for w in _WORDS.findall(text.lower()):
        found[w] = found.get(w, 0) + 1
    return found


def _calibrate(models: Models, held: list[tuple[str, str]]) -> None:
    entropies, _ = Scorer(models).entropies([text for _, text in held])
    some = np.flatnonzero(~np.isnan(entropies[:, 0]))
    entropies, truth = entropies[some], [held[k][0] for k in some.tolist()]
    if not len(some):
        return
    best = entropies.argmin(axis=1)
    x = _margins(entropies)
    own = np.array([models.langs[k] == lang for k, lang in zip(best.tolist(), truth, strict=True)])
    slope, offset = 1.0, 0.0
    y = (own * (len(own) - 1) + 0.5) / len(own)  # keeps the fit finite where all are right
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        w = p * (1 - p) + 1e-9
        gradient = np.array([(x * (y - p)).sum(), (y - p).sum()]) - 1e-3 * np.array([slope, offset])
        hessian = np.array([[(w * x * x).sum(), (w * x).sum()], [(w * x).sum(), w.sum()]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        slope, offset = slope + step[0], offset + step[1]
        if np.abs(step).max() < 1e-9:
            break
    models.slope, models.offset = max(float(slope), 0.0), float(offset)
    lowest = entropies.min(axis=1)
    groups = {k: lowest[own & (best == k)] for k in range(len(models.langs))}
    gaps = np.concatenate([v - np.median(v) for v in groups.values() if len(v)] or [np.zeros(0)])
    for k, values in groups.items():
        if len(values) >= FEW:
            models.limits[k] = 2 * np.quantile(values, QUANTILE) - np.median(values)
        elif len(values) and len(gaps) >= FEW:
            models.limits[k] = np.median(values) + 2 * np.quantile(gaps, QUANTILE)


def _margins(entropies: np.ndarray) -> np.ndarray:
    """How far the second language is behind the first; 1 where there is but one."""
    if entropies.shape[1] < 2:
        return np.ones(len(entropies))
    two = np.partition(entropies, 1, axis=1)
    return two[:, 1] - two[:, 0]


class Scorer:
    def __init__(self, models: Models):
        self.models = models
        self.rows: dict[str, int] = {}
        self.chars = 0
        self.table = np.zeros((1 << 12, len(models.langs) + 1))

    def _learn(self, tokens: list[str]) -> None:
        """A row per token: log2 probabilities of its words by language, then their symbols."""
        parts = [_WORDS.findall(t.lower()) for t in tokens]
        words = list(dict.fromkeys(chain.from_iterable(parts)))
        row = {w: k for k, w in enumerate(words)}
        start, need = len(self.rows), len(self.rows) + len(tokens)
        while len(self.table) < need:
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[start:need] = 0.0
        if words:
            logs, sizes = self.models.log_probabilities(words)
            values = np.column_stack([logs, sizes])
            counts = np.fromiter(map(len, parts), np.int64, len(parts))
            some = np.flatnonzero(counts)
            at = np.fromiter(map(row.__getitem__, chain.from_iterable(parts)), np.int64, int(counts.sum()))
            self.table[start + some] = np.add.reduceat(values[at], np.concatenate([[0], np.cumsum(counts[some])[:-1]]), axis=0)
        self.rows.update(zip(tokens, range(start, need), strict=True))
        self.chars += sum(map(len, tokens))

    def _sums(self, texts: list[list[str]]) -> np.ndarray:
        """What the rows of each text's tokens add up to."""
        if len(self.rows) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.rows.clear()
            self.chars = 0
        if new := set().union(*texts).difference(self.rows):
            self._learn(sorted(new))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        at = np.fromiter(map(self.rows.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
        out = np.zeros((len(texts), self.table.shape[1]))
        some = np.flatnonzero(sizes)
        if len(at) > 2 * _AT_ONCE:  # one very long text
            out[some[0]] = np.bincount(at, minlength=len(self.rows)) @ self.table[: len(self.rows)]
        elif len(some):
            out[some] = np.add.reduceat(self.table[at], np.concatenate([[0], np.cumsum(sizes[some])[:-1]]), axis=0)
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropies in bits a symbol by text and language, nan without a letter; and the symbols of each text."""
        totals, held, size = [], [], 0
        for text in texts:
            tokens = text.split() if text else []
            if held and size + len(tokens) > _AT_ONCE:
                totals.append(self._sums(held))
                held, size = [], 0
            held.append(tokens)
            size += len(tokens)
        totals.append(self._sums(held))
        total = np.concatenate(totals)
        symbols = total[:, -1]
        return np.where(symbols[:, None] > 0, -total[:, :-1] / np.maximum(symbols, 1)[:, None], np.nan), symbols

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and acceptance of each text."""
        models = self.models
        none = np.ones(len(texts), bool)
        if models.langs and texts:
            entropies, symbols = self.entropies(texts)
            none = np.isnan(entropies[:, 0])
        if none.all():
            return [UND] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        entropies[none] = 0.0
        best = entropies.argmin(axis=1)
        score = 1 / (1 + np.exp(-np.clip(models.slope * _margins(entropies) + models.offset, -30, 30)))
        accepted = entropies.min(axis=1) <= models.limits[best] + SLACK / np.sqrt(np.maximum(symbols, 1))
        return [UND if n else models.langs[k] for n, k in zip(none.tolist(), best.tolist(), strict=True)], np.where(none, 0.0, score), accepted & ~none


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Models:
    """Models from rows (doc_id, text, lang); about sample_docs of each language, picked by hash of the id and text.

    One task fits them, as texts and counts would weigh on the driver.
    """
    rows = labelled.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    pick = F.pmod(F.xxhash64(F.col("doc_id"), F.length("text")), F.lit(1 << 30))
    share: Column = F.lit(False)
    for lang, n in sizes.items():
        share |= (F.col("lang") == lang) & (pick <= int((1 << 30) * min(1.0, sample_docs / n)))
    if not sizes:
        return _fit_counts({})
    bounded_batches(rows.sparkSession)
    found = rows.filter(share).select("doc_id", F.substring("text", 1, sample_chars).alias("text"), "lang").repartition(1).sortWithinPartitions("doc_id", "text")
    made = found.mapInArrow(_fitted, "models binary").collect()
    return pickle.loads(made[0].models) if made else _fit_counts({})


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The models of the sample's texts (doc_id, text, lang), which come in order; they are small, so the driver gets them alone."""
    alone("langid")
    samples: dict[str, dict[str, int]] = {}
    held: list[tuple[str, str]] = []
    seen: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            seen[lang] = seen.get(lang, 0) + 1
            if seen[lang] % CALIBRATION == 0:
                held.append((lang, text))
                continue
            words = samples.setdefault(lang, {})
            for w, n in _words(text).items():
                words[w] = words.get(w, 0) + n
    models = _fit_counts({lang: words for lang, words in samples.items() if words})
    if models.langs and held:
        _calibrate(models, held)
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(models)], pa.binary())], names=["models"])
    trim()


def _predicted(batches: Iterator[pa.RecordBatch], models: Models) -> Iterator[pa.RecordBatch]:
    """The text is the last column; it gives way to the prediction."""
    alone("langid")
    scorer = Scorer(models)
    for batch in batches:
        *kept, text = batch.columns
        langs, scores, accepted = scorer.predict(text.to_pylist())
        made = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())]
        yield pa.RecordBatch.from_arrays([*kept, *made], names=[*batch.schema.names[:-1], "lang_pred", "score", "accepted"])
    del scorer
    trim()


def predict(docs: DataFrame, models: Models, keep: list[str | Column] | None = None) -> DataFrame:
    """keep (doc_id by default), lang_pred, score and accepted of every row's whole text."""
    bounded_batches(docs.sparkSession)
    kept = docs.select(*(["doc_id"] if keep is None else keep))
    slim = docs.select(*(["doc_id"] if keep is None else keep), F.col("text").cast("string").alias("__text"))
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())])
    return slim.mapInArrow(lambda b: _predicted(b, models), schema)
