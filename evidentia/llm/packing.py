"""Packing: documents as token pieces in sequences of a fixed capacity, planned by cutting-stock column generation.

A document's ids end with END. Null text counts as empty and gives END alone. Ids are cut after every whole capacity;
what remains is cut once more at a multiple of QUANTUM, so that the linear program has few lengths with many pieces
each. Pieces are ranked within their length by (doc_id, start) and take the plan's slots in that order. Rows that
share a doc_id are documents of their own; rows alike in all columns may swap places. An empty table gives no pieces.
Ranks come from counts by (length, bucket of doc_id), so no length's pieces meet in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidentia.llm import cutting_stock
from evidentia.llm.common import alone, bounded_batches, scratch_table, text_or_empty
from evidentia.llm.token_ids import IdEncoder, grouped

END = 0
CAPACITY = 1024
QUANTUM = 32
#: Pieces that one bucket of doc_id should hold.
BUCKET = 20_000
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cuts(tokens: int, capacity: int, quantum: int) -> list[int]:
    """Piece lengths of a document, in order."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [k for k in (rest - rest % quantum, rest % quantum) if k]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, quantum: int) -> Iterator[pa.RecordBatch]:
    alone("token_ids")
    encoder = IdEncoder.shared(path)
    end = np.array([END], "<u4").tobytes()
    for batch in grouped(batches, 1):
        columns: list[list] = [[], [], [], [], []]
        for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
            ids += end
            start = 0
            for length in cuts(len(ids) // 4, capacity, quantum):
                values = (doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), len(ids) // 4)
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
                start += length
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[x.split()[0] for x in _PIECES.split(", ")])


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, quantum: int = QUANTUM) -> DataFrame:
    """Pieces of every whole text, before they have a place."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(lambda b: _pieces(b, tokenizer, capacity, quantum), _PIECES)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, quantum: int = QUANTUM) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    cut = scratch_table(pieces(docs, tokenizer, capacity, quantum), "pieces")
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    whole = histogram.pop(capacity, 0)
    plan = cutting_stock.plan(histogram, capacity)
    buckets = max(1, -(-(sum(histogram.values()) + whole) // BUCKET))
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n")).select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "doc_tokens", "ids_crc32")
    ranked = dealt.withColumn("place", F.row_number().over(within) - 1).join(base, ["length", "bucket"]).withColumn("rank", F.col("base") + F.col("place"))
    rows = [tuple(int(v) for v in r) for r in zip(plan.length, plan.first, plan.copies, plan.sequence, plan.offset, strict=True)]
    ends = {}
    for length, first, *_ in reversed(rows):
        ends[length, first] = min((f for n, f, *_ in rows if n == length and f > first), default=1 << 62)
    rows = [(*r, ends[r[0], r[1]]) for r in rows] + [(capacity, 0, 1, plan.sequences, 0, 1 << 62)]
    slots = spark.createDataFrame(rows, "length long, first long, copies long, sequence long, slot long, next long")
    placed = ranked.join(F.broadcast(slots), "length").filter((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("next")))
    k = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        F.expr("sequence + (rank - first) DIV copies").cast("long").alias("sequence_id"),
        (F.col("slot") + k % F.col("copies") * F.col("length")).cast("long").alias("offset"),
    )
