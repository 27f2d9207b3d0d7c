"""SimHash near-duplicates: BK-trees over shards of fingerprints, then connected components.

Texts are lower-cased in A-Z; words are runs of other than white space; a shingle is SHINGLE words joined by spaces
(fewer words: all of them; none: fingerprint zero). A bit is 1 if it is set in over half of the shingles' XXH64.
Null text counts as empty. Fingerprints link at RADIUS or fewer differing bits; a document's component is the smallest
doc_id it reaches. Rows that share a doc_id link like any others; a null doc_id is never the smallest unless all are.

Two fingerprints within RADIUS agree in one of RADIUS + 1 bit blocks, so the trees are built per (block, value) shard:
nodes are distinct fingerprints, a child's key is its Hamming distance to the parent, and a search follows only edges
within the radius. A tree's shard is dealt by key instead of broadcast, as it grows with the corpus. A shard above SHARD
nodes is split by RADIUS + 1 blocks of the bits that its nodes do not share yet, and so once more; what agrees in three
such blocks has some 19 bits left to differ in, which bounds the last trees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import bounded_batches, drop_tables, scratch_table, text_or_empty

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Distinct fingerprints up to which a shard gets one tree.
SHARD = 2048
_NULL = -(1 << 63)


def _split(mask: int, parts: int) -> list[int]:
    """The mask with each of so many blocks of the bits that it lacks."""
    free = [b for b in range(64) if not mask >> b & 1]
    ends = [k * len(free) // parts for k in range(parts + 1)]
    return [mask | sum(1 << b for b in free[i:j]) for i, j in zip(ends, ends[1:], strict=False)]


#: Bits that shards agree in, by depth and path.
_MASKS = [_split(0, RADIUS + 1)]
for _ in range(2):
    _MASKS.append([m for mask in _MASKS[-1] for m in _split(mask, RADIUS + 1)])


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), "<u8", len(grams))
    bits = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        bits += np.unpackbits(hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(grams), bitorder="little").tobytes(), "little")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [signed(fingerprint(x, shingle)) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.int64())], names=["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash (XXH64 of the text) and fp, the fingerprint as a signed long, of every row's whole text."""
    bounded_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_or_empty()).alias("text_hash"), text_or_empty().alias("text"))
    return slim.mapInArrow(lambda b: _fingerprints(b, shingle), "doc_id long, text_hash long, fp long")


class BKTree:
    """Tree over distinct numbers; the children of a node are keyed by their Hamming distance to it."""

    def __init__(self) -> None:
        self.nodes: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, x: int) -> None:
        self.nodes.append(x)
        self.children.append({})
        at, new = 0, len(self.nodes) - 1
        while at != new:
            at = self.children[at].setdefault((self.nodes[at] ^ x).bit_count(), new)

    def within(self, x: int, radius: int) -> list[int]:
        """Nodes at most radius from x."""
        found, open_ = [], [0] if self.nodes else []
        while open_:
            at = open_.pop()
            d = (self.nodes[at] ^ x).bit_count()
            if d <= radius:
                found.append(self.nodes[at])
            edges = self.children[at]
            open_ += [edges[k] for k in range(max(1, d - radius), d + radius + 1) if k in edges]
        return found


def shard_links(members: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one shard: pairs (fingerprint, one that it reaches)."""
    parent = {x: x for x in members}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    tree, links = BKTree(), []
    for x in members:
        for y in tree.within(x, radius):
            if (a := root(x)) != (b := root(y)):
                parent[a] = b
                links.append((x, y))
        tree.add(x)
    return links


def _links(frames: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by shard; a shard may go on in the next batch."""
    shard, members = None, []

    def flush() -> pd.DataFrame:
        found = shard_links(members, radius) if len(members) > 1 else []
        return pd.DataFrame([(signed(a), signed(b)) for a, b in found], columns=["a", "b"], dtype="int64")

    for frame in frames:
        for *key, fp in zip(*(frame[c].tolist() for c in ("depth", "path", "value", "fp")), strict=True):
            if key != shard:
                if len(members) > 1:
                    yield flush()
                shard, members = key, []
            members.append(fp & ((1 << 64) - 1))
    if len(members) > 1:
        yield flush()


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that give their components; no shard emits all its pairs."""
    if radius != RADIUS:
        raise ValueError("the blocks are made for a radius of 2")
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shard = lambda path, mask: F.struct(path.alias("path"), F.col("fp").bitwiseAND(mask).alias("value"))
    keyed = distinct.select("fp", F.explode(F.array(*(shard(F.lit(k), F.lit(signed(m))) for k, m in enumerate(_MASKS[0])))).alias("x"))
    found = None
    for depth in range(len(_MASKS)):
        keyed = keyed.select(F.lit(depth).alias("depth"), "x.path", "x.value", "fp")
        sizes = scratch_table(keyed.groupBy("depth", "path", "value").agg(F.count("*").alias("n")).filter("n > 1"), "shard-sizes")
        shared = keyed.join(sizes, ["depth", "path", "value"])
        more = depth + 1 < len(_MASKS) and not sizes.filter(F.col("n") > SHARD).isEmpty()
        small = shared.filter(F.col("n") <= SHARD) if more else shared
        dealt = small.select("depth", "path", "value", "fp").repartition(parts, "depth", "path", "value").sortWithinPartitions("depth", "path", "value", "fp")
        trees = dealt.mapInPandas(lambda f: _links(f, radius), "a long, b long")
        found = trees if found is None else found.unionByName(trees)
        if not more:
            break
        masks = F.array(*(F.lit(signed(m)) for m in _MASKS[depth + 1]))
        child = lambda k: F.col("path") * (RADIUS + 1) + k
        large = scratch_table(shared.filter(F.col("n") > SHARD).select("path", "fp"), "large-shards")
        keyed = large.select("fp", F.explode(F.array(*(shard(child(k), F.get(masks, child(k))) for k in range(RADIUS + 1)))).alias("x"))
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the least node reached.

    Rounds of large and small stars, each written to the shared folder; they end when the edges no longer change.
    """
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = scratch_table(edges.select("a", "b").distinct(), "edges")
    before = None
    while True:
        least = both(edges).groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both(edges).join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.filter("m < a").select("a", F.col("m").alias("b"))).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        old, edges = edges, scratch_table(small.filter("a != b").distinct(), "edges")
        drop_tables(old)
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, text_hash, fp, group (the least fingerprint of its component) and component_id."""
    found = scratch_table(fingerprints(docs, shingle), "fingerprints")
    distinct = found.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp")))
    grouped = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("group"))
    ids = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    labels = grouped.join(ids, "group").select("fp", "group", "component_id")
    return found.join(labels, "fp").select("doc_id", "text_hash", "fp", "group", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """docs with one row of each component of near_duplicates."""
    return first_rows(docs, near_duplicates(docs, shingle))


def first_rows(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with one row of each group of found: the smallest doc_id (any before null), of its rows the least text hash."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    kept = found.groupBy("group").agg(first).select(F.coalesce("first.doc_id", F.lit(_NULL)).alias("__d"), F.col("first.text_hash").alias("__h"))
    keys = [F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)).alias("__d"), F.xxhash64(text_or_empty()).alias("__h")]
    rows = docs.select(*keys, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"))
    return rows.join(kept, ["__d", "__h"], "left_semi").dropDuplicates(["__d", "__h"]).select("__row.*")


def hex_digits(fp: str = "fp"):
    """The fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
