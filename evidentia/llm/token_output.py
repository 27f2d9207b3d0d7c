"""Token-id files: whole texts as ids in ascending doc_id order, coded in blocks by a static numeral system (`rans`).

Each document's ids end with END. Null text counts as empty and gives END alone; so does an empty one. Rows that
share a doc_id stand in the order of their texts, each as a document of its own; a null doc_id comes first and is
written as the least 64-bit integer. Empty tables give no blocks. Extra columns are not read.

Stages: rows are dealt by ranges of doc_id, tokenised there into blocks of about BLOCK_IDS ids and stored once; symbol
counts over all documents make the shared table; every block is then coded by itself, whichever executor does it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.llm import rans
from evidentia.llm.common import alone, bounded_batches, scratch_table, spread, table_bytes, text_or_empty
from evidentia.llm.token_ids import IdEncoder, grouped

END = 0
BLOCK_IDS = 1 << 20
#: Bytes of the table, as its files tell, that one range of doc_id should hold.
RANGE_BYTES = 10 << 20
#: Ranges at most: their offsets go to the driver. A range is streamed, so larger ones need no more memory.
MOST_RANGES = 1 << 17
NULL_ID = -(1 << 63)

_RAW = "part int, block int, before long, n long, doc_ids binary, lengths binary, ids binary, symbols array<int>, counts array<long>"
_CODED = "part int, block int, before long, n long, payload binary"
_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _tokenised(batches: Iterator[pa.RecordBatch], path: str, block_ids: int) -> Iterator[pa.RecordBatch]:
    alone("token_ids")
    encoder = IdEncoder.shared(path)
    end = np.array([END], "<u4").tobytes()
    counts = np.zeros(encoder.vocabulary, np.int64)
    part, block, before, size = TaskContext.get().partitionId(), 0, 0, 0
    held: list[bytes] = []
    doc_ids: list[int] = []

    def row(ids: np.ndarray, symbols: np.ndarray, tallies: np.ndarray) -> pa.RecordBatch:
        lengths = np.array([len(x) // 4 for x in held], "<u4")
        values = [part, block, before, size, np.array(doc_ids, "<i8").tobytes(), lengths.tobytes(), ids.astype(kind).tobytes(), symbols.astype(np.int32), tallies]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=[x.split()[0] for x in _RAW.split(", ")])

    def all_held() -> np.ndarray:
        nonlocal counts
        ids = np.frombuffer(b"".join(held), "<u4")
        counts += np.bincount(ids, minlength=len(counts))
        return ids

    none, kind = np.zeros(0, np.int64), _kind(encoder.vocabulary)
    for batch in grouped(batches, 1):
        for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
            held.append(ids + end)
            doc_ids.append(NULL_ID if doc_id is None else doc_id)
            size += len(ids) // 4 + 1
            if size >= block_ids:
                yield row(all_held(), none, none)
                block, before, size, held, doc_ids = block + 1, before + size, 0, [], []
    last = all_held()
    if counts.any():
        seen = counts.nonzero()[0]
        yield row(last, seen, counts[seen])


def _kind(vocabulary: int) -> str:
    """How ids are stored until they are coded."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _coded(batches: Iterator[pa.RecordBatch], freq: np.ndarray, kind: str) -> Iterator[pa.RecordBatch]:
    table = rans.Table.from_frequencies(freq)
    for batch in batches:
        for x in batch.to_pylist():
            payload = rans.encode(table, np.frombuffer(x["doc_ids"], "<i8"), np.frombuffer(x["lengths"], "<u4"), np.frombuffer(x["ids"], kind))
            yield pa.RecordBatch.from_pylist([{"part": x["part"], "block": x["block"], "before": x["before"], "n": x["n"], "payload": payload}], schema=pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n", pa.int64()), ("payload", pa.binary())]))


def _decoded(batches: Iterator[pa.RecordBatch], freq: np.ndarray, offsets: dict[int, int]) -> Iterator[pd.DataFrame]:
    table = rans.Table.from_frequencies(freq)
    for batch in batches:
        for x in batch.to_pylist():
            doc_ids, lengths, ids = rans.decode(table, x["payload"])
            raw, ends = ids.astype("<u4").tobytes(), np.cumsum(lengths, dtype=np.int64)
            starts = ends - lengths
            crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            names = pd.array(doc_ids, dtype="Int64")
            names[doc_ids == NULL_ID] = pd.NA
            frame = pd.DataFrame({"doc_id": names, "start": offsets[x["part"]] + x["before"] + starts, "n_tokens": lengths.astype(np.int64), "ids_crc32": np.array(crcs, np.int64)})
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)


def write(docs: DataFrame, to: str, tokenizer: str, block_ids: int = BLOCK_IDS) -> None:
    """Token-id files of docs (doc_id, text) in folder `to`: `table` has the frequencies, `blocks` the coded blocks, `parts` each range's offset.

    The block rows are Parquet only as a container that any store takes; a payload is complete without it.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    slim = docs.select("doc_id", text_or_empty().alias("text"))
    ranges = spread(spark, table_bytes(docs), RANGE_BYTES, MOST_RANGES)
    ordered = slim.repartitionByRange(ranges, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    raw = scratch_table(ordered.mapInArrow(lambda b: _tokenised(b, tokenizer, block_ids), _RAW), "token-ids", codec="snappy", large=True)
    kind = _kind(IdEncoder.shared(tokenizer).vocabulary)
    tallies = raw.select(F.explode(F.arrays_zip("symbols", "counts")).alias("x")).groupBy("x.symbols").agg(F.sum("x.counts").alias("n")).collect()
    counts = np.zeros(max((r.symbols for r in tallies), default=-1) + 1, np.int64)
    for r in tallies:
        counts[r.symbols] = r.n
    freq = rans.Table.of(counts).freq.astype("<u4")
    spark.createDataFrame([(freq.tobytes(),)], "freq binary").coalesce(1).write.parquet(f"{to}/table")
    per_part = raw.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part")
    per_part.write.parquet(f"{to}/parts")
    raw.select("part", "block", "before", "n", "doc_ids", "lengths", "ids").mapInArrow(lambda b: _coded(b, freq, kind), _CODED).write.option("compression", "none").parquet(f"{to}/blocks")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all before it), n_tokens, ids_crc32."""
    bounded_batches(spark)
    freq = np.frombuffer(spark.read.parquet(f"{folder}/table").first().freq, "<u4")
    offsets, total = {}, 0
    for r in spark.read.parquet(f"{folder}/parts").orderBy("part").collect():
        offsets[r.part], total = total, total + r.n
    return spark.read.schema(_CODED).parquet(f"{folder}/blocks").mapInArrow(lambda b: _decoded(b, freq, offsets), _READ)
