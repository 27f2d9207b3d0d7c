"""Near copies: an exact set-similarity join of whole texts, then connected components.

Words are as in `simhash`; a text's set holds the 64-bit hashes of its shingles of SHINGLE words (fewer words: all of
them; none: the empty set). Texts link if their sets are equal or have Jaccard similarity THRESHOLD or more; a component
is what links reach. Null text counts as empty.

Equal sets are met by their hash. Between different ones the join is a prefix filter: shingles are ordered by rarity
(texts with their hash bucket, over all texts), similar sets share one among their first n - ceil(t n) + 1, and a pair
goes on only if sizes and the places of the shared shingle allow the similarity. What is left is verified on the sets
themselves. Prefixes travel packed, by the shard of their hash, and only lists that several sets share become rows. Each
list first meets its smallest set; only sets that this has not brought into one component meet each other, so a large
group of near copies does not pair all its members.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import Names, alone, bounded_batches, owns, scratch_table, spread, table_bytes, text_or_empty, trim
from evidentia.llm.simhash import SEED, components, signed

SHINGLE = 5
#: Similarity as a fraction.
THRESHOLD = (4, 5)
#: Buckets of the rarity table, and the parts in which tasks' counts are added up.
BUCKETS, PARTS = 1 << 20, 64
#: Bytes of the table, as its files tell, whose prefixes one shard should hold, and texts that are packed together.
SHARD_BYTES = 16 << 20
PACKED = 4096
#: Texts to verify are picked by a broadcast join up to so many.
BROADCAST_ROWS = 1_000_000
_NAMES = Names(lambda word: xxhash.xxh64_intdigest(word, SEED))
owns("nearcopies", _NAMES.clear)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_ROW = "doc_id long, text_hash long, s long, n long, shard int, entries binary"
_ENTRY = np.dtype([("token", "<u8"), ("s", "<i8"), ("n", "<u4"), ("p", "<u4")])
_SHARED = "token long, s long, n long, p int, fs long, fn long, fp int"


def shingles(text: str) -> np.ndarray:
    """Sorted distinct hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    names = np.fromiter(map(_NAMES.__getitem__, words), np.uint64, len(words))
    whole = max(1, len(names) - SHINGLE + 1)
    out = np.full(whole, np.uint64(len(names) if len(names) < SHINGLE else 0))
    for k in range(min(SHINGLE, len(names))):
        out = (out ^ (out >> np.uint64(29))) * _ODD[k] + names[k : k + whole]
    out = (out ^ (out >> np.uint64(32))) * _ODD[0]
    return np.unique(out ^ (out >> np.uint64(29)))


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


def _prefix(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The rarest hashes, as many as similar sets need to share one."""
    num, den = THRESHOLD
    n = len(hashes)
    return hashes[np.lexsort((hashes, levels[_buckets(hashes)]))[: n - -(-n * num // den) + 1]] if n else hashes


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts by bucket of their shingles, of a task, in PARTS rows."""
    alone("nearcopies")
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        found = [_buckets(shingles(x)) for x in batch.column(0).to_pylist()]
        if found:
            counts += np.bincount(np.concatenate(found), minlength=BUCKETS)
    blobs = [zlib.compress(x.tobytes(), 1) for x in counts.astype("<i8").reshape(PARTS, -1)]
    yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(blobs, pa.binary())], names=["part", "counts"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a part (or of several) added up."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts = np.frombuffer(zlib.decompress(blob), "<i8")
            sums[part] = sums[part] + counts if part in sums else counts
    blobs = [zlib.compress(x.tobytes(), 1) for x in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "counts"])


def _levels(docs: DataFrame) -> np.ndarray:
    """Per bucket four steps to a doubling of its texts, of all texts: BUCKETS bytes whatever their number."""
    schema = "part int, counts binary"
    tallies = docs.select(text_or_empty().alias("text")).mapInArrow(_counted, schema)
    counts = np.zeros((PARTS, BUCKETS // PARTS), np.int64)
    for r in tallies.repartitionById(PARTS, "part").mapInArrow(_summed, schema).collect():
        counts[r.part] = np.frombuffer(zlib.decompress(r.counts), "<i8")
    return (4 * np.log2(np.maximum(counts.reshape(-1), 1))).astype(np.uint8)


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*values, np.zeros(0, np.uint64)]).view(np.int64)))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [shingles(x) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), _lists(values)], names=["s", "w"])


def _digested(batches: Iterator[pa.RecordBatch], levels: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """A row for each text; now and then rows with the prefixes of the distinct sets since, by shard."""
    held: dict[int, tuple[int, np.ndarray]] = {}

    def row(doc_id: list, text_hash: list, s: list, n: list, shard: list, entries: list) -> pa.RecordBatch:
        types = [pa.int64()] * 4 + [pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((doc_id, text_hash, s, n, shard, entries), types, strict=True)], names=[x.split()[0] for x in _ROW.split(", ")])

    def packed() -> Iterator[pa.RecordBatch]:
        sizes = [len(x) for _, x in held.values()]
        entries = np.zeros(sum(sizes), _ENTRY)
        if not len(entries):
            return
        entries["token"] = np.concatenate([x for _, x in held.values()])
        entries["s"] = np.repeat(np.fromiter(held, np.int64, len(held)), sizes)
        entries["n"] = np.repeat([n for n, _ in held.values()], sizes)
        entries["p"] = np.concatenate([np.arange(k) for k in sizes])
        shard = ((entries["token"] >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        some, starts = np.unique(shard[order], return_index=True)
        blobs = [x.tobytes() for x in np.split(entries[order], starts[1:])]
        none = [None] * len(some)
        yield row(none, none, none, none, some.tolist(), blobs)

    for batch in batches:
        columns: list[list] = [[], []]
        for text in batch.column(2).to_pylist():
            found = shingles(text)
            key = signed(xxhash.xxh64_intdigest(found.tobytes(), SEED))
            columns[0].append(key)
            columns[1].append(len(found))
            if key not in held:
                held[key] = (len(found), _prefix(found, levels))
        none = [None] * len(columns[0])
        yield row(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *columns, none, none)
        if len(held) >= PACKED:
            yield from packed()
            held.clear()
    yield from packed()
    held.clear()
    trim()


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lists of a shard that several sets share, each with its smallest set (of equals the least hash)."""
    blobs = [blob for batch in batches for blob in batch.column(1).to_pylist()]
    entries = np.frombuffer(b"".join(blobs), _ENTRY)
    if not len(entries):
        return
    entries = entries[np.lexsort((entries["s"], entries["n"], entries["token"]))]
    again = (entries["token"][1:] == entries["token"][:-1]) & (entries["s"][1:] == entries["s"][:-1])
    entries = entries[np.concatenate([[True], ~again])]
    fresh = np.concatenate([[True], entries["token"][1:] != entries["token"][:-1]])
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    size = np.bincount(first, minlength=len(entries))[first]
    for start in range(0, len(entries), 1 << 16):
        kept = np.flatnonzero(size[start : start + (1 << 16)] > 1) + start
        x, y = entries[kept], entries[first[kept]]
        columns = [x["token"].astype(np.int64), x["s"], x["n"].astype(np.int64), x["p"].astype(np.int32), y["s"], y["n"].astype(np.int64), y["p"].astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=[c.split()[0] for c in _SHARED.split(", ")])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_or_empty()).alias("text_hash"), text_or_empty().alias("text"))


def _may_match(x: str, y: str) -> Column:
    """Sets of n shingles that share one at their places p: sizes and places allow the similarity."""
    num, den = THRESHOLD
    overlap = f"(({x}n + {y}n) * {num} + {num + den - 1}) DIV {num + den}"
    return F.expr(f"{x}n * {den} >= {y}n * {num} AND {y}n * {den} >= {x}n * {num} AND least({x}n - {x}p, {y}n - {y}p) >= {overlap}")


def _verified(docs: DataFrame, found: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of sets that are similar enough."""
    num, den = THRESHOLD
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("s")).distinct()
    rows = found.join(wanted, "s").groupBy("s").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("x"))
    rows = scratch_table(rows.select("s", F.col("x.doc_id").alias("d"), F.col("x.text_hash").alias("h")), "wanted-texts")
    if rows.count() <= BROADCAST_ROWS:
        rows = F.broadcast(rows)
    texts = _keyed(docs).join(rows, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))).select("s", "text")
    sets = scratch_table(texts.mapInArrow(_sets, "s long, w array<long>").dropDuplicates(["s"]), "wanted-sets")
    a, b = (sets.select(F.col("s").alias(c), F.col("w").alias(f"{c}w")) for c in "ab")
    both = pairs.join(a, "a").join(b, "b").withColumn("o", F.size(F.array_intersect("aw", "bw")))
    return both.filter(F.expr(f"o * {den} >= (size(aw) + size(bw) - o) * {num}")).select("a", "b")


def near_copies(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_hash (XXH64 of the text) and group, the least set hash of its component."""
    bounded_batches(docs.sparkSession)
    shards = spread(docs.sparkSession, table_bytes(docs), SHARD_BYTES)
    levels = _levels(docs)
    rows = scratch_table(_keyed(docs).mapInArrow(lambda b: _digested(b, levels, shards), _ROW), "text-sets")
    found = rows.filter("shard IS NULL").select("doc_id", "text_hash", "s", "n")
    posted = rows.filter("shard IS NOT NULL").select("shard", "entries").repartitionById(shards, "shard")
    lists = scratch_table(posted.mapInArrow(_shared, _SHARED), "shared-shingles", large=True)
    firsts = lists.filter("s <> fs").filter(_may_match("", "f")).select(F.least("s", "fs").alias("a"), F.greatest("s", "fs").alias("b")).distinct()
    firsts = scratch_table(firsts, "first-pairs")
    edges = scratch_table(_verified(docs, found, firsts), "first-edges")
    roots = components(edges).select(F.col("node").alias("s"), "root")
    labelled = lists.select("token", "s", "n", "p").join(roots, "s", "left").withColumn("root", F.coalesce("root", "s"))
    mixed = labelled.groupBy("token").agg(F.min("root").alias("l"), F.max("root").alias("m")).filter("l <> m").select("token")
    open_ = scratch_table(labelled.join(mixed, "token", "left_semi"), "open-lists")
    x, y = open_.alias("x"), open_.alias("y")
    rest = x.join(y, (F.col("x.token") == F.col("y.token")) & F.expr("x.s < y.s AND x.root <> y.root") & _may_match("x.", "y."))
    rest = rest.select(F.col("x.s").alias("a"), F.col("y.s").alias("b")).distinct().join(firsts, ["a", "b"], "left_anti")
    rest = scratch_table(rest, "other-pairs", large=True)
    more = scratch_table(_verified(docs, found, rest), "other-edges")
    groups = components(edges.unionByName(more)).select(F.col("node").alias("s"), "root")
    return found.select("doc_id", "text_hash", "s").join(groups, "s", "left").select("doc_id", "text_hash", F.coalesce("root", "s").alias("group"))


def merged(found: DataFrame, others: DataFrame) -> DataFrame:
    """found (doc_id, text_hash, group) with groups joined where a group of others (text_hash, group) reaches several.

    Both kinds of groups depend on the text alone, so they meet by its hash.
    """
    met = others.select("text_hash", F.col("group").alias("other")).distinct().join(found.select("text_hash", "group").distinct(), "text_hash")
    met = scratch_table(met.select("other", "group").distinct(), "met-groups")
    least = met.groupBy("other").agg(F.min("group").alias("b"))
    edges = met.join(least, "other").filter("group <> b").select(F.col("group").alias("a"), "b")
    roots = components(edges).withColumnRenamed("node", "group")
    return found.join(roots, "group", "left").select("doc_id", "text_hash", F.coalesce("root", "group").alias("group"))
