"""Document fingerprints: closed syncmers, and what a text shares with its edited form and with the next document.

A K-mer of code points is an anchor if its least S-mer (by hash) stands at its first or last place. That depends on the
K-mer alone, so equal passages have equal anchors wherever they stand. Texts are matched by position over all their
anchors: an anchor is its hash and how many like it came before in its text, and likeness (`near_edited`, `near_next`)
is the share of those that both texts have in the same order, the most that can be so, among all of both (1 for two
empty texts). The fingerprint that is shown is the SKETCH least distinct anchor hashes, 32 bits each, in base64;
`sketch_edited` and `sketch_next` are what it alone tells, the share of common hashes among the least of both. A text
without an anchor (fewer than K characters, or none by chance) has one hash, of the whole text; an empty one none. Null text counts as empty. The next document is the one with the next smaller doc_id, and after the
last the first; rows that share a doc_id follow in the order of their texts, a null doc_id comes last. One document is
its own next. Rows are dealt by ranges of doc_id, and each range also gets the first document of the range after it.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import bounded_batches, spread, table_bytes, text_or_empty

K, S = 16, 8
SKETCH = 128
#: Bytes of the table, as its files tell, that one range of doc_id should hold.
RANGE_BYTES = 2 << 20
#: Ranges at most: their bounds go to the driver. A range is streamed, so larger ones need no more memory.
MOST_RANGES = 1 << 14
_NULL = -(1 << 63)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_FINGERPRINTED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, sketch_edited double, sketch_next double"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def syncmers(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and 64-bit hashes of a text's anchors."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if len(c) < K:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    pairs = c[:-1] * _A + c[1:]
    fours = pairs[:-2] * _B + pairs[2:]
    s_mers = _mix(fours[:-4] * _C + fours[4:])
    low = np.minimum(s_mers[:-1], s_mers[1:])
    low = np.minimum(low[:-2], low[2:])
    low = np.minimum(low[:-4], low[4:])
    n = len(c) - K + 1
    first, last = s_mers[:n], s_mers[K - S : K - S + n]
    least = np.minimum(low[:n], last)
    at = np.flatnonzero((first == least) | (last == least))
    return at, _mix(first[at] * _A + s_mers[at + S])


def _hashes(text: str) -> np.ndarray:
    """Hashes of the anchors in their order; of a text without any, of the whole text."""
    _, hashes = syncmers(text)
    if len(hashes) or not text:
        return hashes
    return np.array([xxhash.xxh32_intdigest(text.encode("utf-8", "surrogatepass"))], np.uint64) << np.uint64(32)


def sketch(text: str) -> np.ndarray:
    """The least distinct anchor hashes."""
    return _least(_hashes(text))


def _least(hashes: np.ndarray) -> np.ndarray:
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    if len(short) > 8 * SKETCH:  # the least few, with room for repeats
        few = np.unique(np.partition(short, 4 * SKETCH)[: 4 * SKETCH])
        if len(few) >= SKETCH:
            return few[:SKETCH]
    return np.unique(short)[:SKETCH]


def _numbered(hashes: np.ndarray) -> np.ndarray:
    """Distinct keys of the anchors in their order: the hash and how many like it came before."""
    order = np.argsort(hashes, kind="stable")
    sorted_, at = hashes[order], np.arange(len(hashes))
    fresh = np.concatenate([[True], sorted_[1:] != sorted_[:-1]])[: len(hashes)]
    keys = np.empty_like(hashes)
    keys[order] = sorted_ + (at - np.maximum.accumulate(np.where(fresh, at, 0))).astype(np.uint64) * _A
    return keys


def match(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the numbered anchors a and b that both have in the same order."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    places = j[np.argsort(i)]
    n = len(places)
    if n > 1 and (places[1:] < places[:-1]).any():  # the longest rising run
        ends: list[int] = []
        for x in places.tolist():
            if not ends or x > ends[-1]:
                ends.append(x)
            else:
                ends[bisect_left(ends, x)] = x
        n = len(ends)
    return n / (len(a) + len(b) - n)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    both = np.union1d(a, b)[:SKETCH]
    if not len(both):
        return 1.0
    return float(np.isin(both, a, assume_unique=True).__and__(np.isin(both, b, assume_unique=True)).sum() / len(both))


def printed(a: np.ndarray) -> str:
    return base64.b64encode(a.astype("<u4").tobytes()).decode()


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            at, hashes = syncmers(text)
            yield pa.RecordBatch.from_arrays([pa.array([doc_id] * len(at), pa.int64()), pa.array(at, pa.int64()), pa.array(hashes.view(np.int64), pa.int64())], names=["doc_id", "place", "anchor"])


def anchors(docs: DataFrame) -> DataFrame:
    """A row per anchor of every whole text: doc_id, place (code points before it), anchor (hash)."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(_anchored, "doc_id long, place long, anchor long")


@dataclass
class _Doc:
    doc_id: int | None
    text: str
    marks: np.ndarray
    anchors: np.ndarray


def _doc(key: int, text: str) -> _Doc:
    hashes = _hashes(text)
    return _Doc(None if key == _NULL else key, text, _least(hashes), _numbered(hashes))


def _row(doc: _Doc, after: _Doc) -> tuple:
    n = len(doc.text)
    edited = doc.text[: n - n // 2] + after.text[: n // 2]
    hashes = _hashes(edited)
    marks = _least(hashes)
    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return doc.doc_id, n, sha, printed(doc.marks), printed(marks), match(doc.anchors, _numbered(hashes)), match(doc.anchors, after.anchors), likeness(doc.marks, marks), likeness(doc.marks, after.marks)


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in their order, then the first document of the next range (role 1)."""
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4]
    names = [x.split()[0] for x in _FINGERPRINTED.split(", ")]
    range_, held = None, None
    for batch in batches:
        out = []
        for bucket, role, key, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if bucket != range_:
                range_, held = bucket, None
            elif held is None:  # the next range's first document had come
                continue
            doc = _doc(key, text)
            if held is not None:
                out.append(_row(held, doc))
            held = None if role else doc
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def fingerprint(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, sketch_edited, sketch_next."""
    spark = docs.sparkSession
    bounded_batches(spark)
    slim = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)).alias("key"), text_or_empty().alias("text"))
    ranges = spread(spark, table_bytes(docs), RANGE_BYTES, MOST_RANGES)
    found = slim.agg(F.percentile_approx("key", [k / ranges for k in range(1, ranges)] or [0.5], 10_000).alias("x")).first().x or []
    splits = np.unique(np.array(found, np.int64))

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(len(splits) - np.searchsorted(splits, key.to_numpy(), side="right"), dtype="int32")

    dealt = slim.select(range_of("key").alias("bucket"), F.lit(0).alias("role"), "key", "text")
    firsts = sorted((r.bucket, r.key) for r in slim.select(range_of("key").alias("bucket"), "key").groupBy("bucket").agg(F.max("key").alias("key")).collect())
    targets = [(key, firsts[k - 1][0]) for k, (_, key) in enumerate(firsts)]
    heads = F.broadcast(spark.createDataFrame(targets, "head long, target int"))
    extra = slim.join(heads, F.col("key") == F.col("head")).select(F.col("target").alias("bucket"), F.lit(1).alias("role"), "key", "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["bucket", "role", F.col("key").desc(), "text"]
    return dealt.unionByName(extra).repartition(max(parts, -(-ranges // 4)), "bucket").sortWithinPartitions(*order).mapInArrow(_fingerprinted, _FINGERPRINTED)
