"""Strict delimited files: all columns text, never NULL, header checked, rows numbered in file order."""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidentia.functions.keys import stable_sha256
from evidentia.functions.text import snake_header

LONGEST_FIELD = 16 << 20


class HeaderDrift(ValueError):
    """The file's header is not the one its contract names."""


def read_header(path: str) -> list[str]:
    """The first record of a local file."""
    with open(path, encoding="utf-8-sig", newline="") as file:
        try:
            return next(csv.reader(file))
        except StopIteration:
            raise ValueError(f"empty file: {path}") from None


def header_of(spark: SparkSession, path: str) -> list[str]:
    """The first record of a file in any file system; its first mebibyte is read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        head = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(spark._jvm.org.apache.commons.io.input.BoundedInputStream(stream, 1 << 20)))
    finally:
        stream.close()
    if not head:
        raise ValueError(f"empty file: {path}")
    return next(csv.reader(io.StringIO(head.decode("utf-8-sig", "ignore"), newline="")))


def check_header(path: str, expected: Sequence[str]) -> None:
    if tuple(found := read_header(path)) != tuple(expected):
        raise HeaderDrift(f"Source header drift: {found} instead of {list(expected)}")


def read_strict(spark: SparkSession, path: str, columns: Sequence[str], header: bool) -> DataFrame:
    """Columns as text with '' for empty fields, and row_number from 1 in file order.

    One file is one multi-line partition, so the number is its place in the file. Rows with other than the expected
    fields stop the read.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.read.schema(schema).options(header=header, quote='"', escape='"', multiLine=True, mode="FAILFAST", maxCharsPerColumn=LONGEST_FIELD, enforceSchema=True, encoding="UTF-8")
    rows = reader.csv(path).select(*(F.coalesce(c, F.lit("")).alias(c) for c in columns))
    return rows.withColumn("source_row_number", F.monotonically_increasing_id() + 1)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """A headed file of labels, all columns text; empty fields are NULL."""
    return spark.read.options(header=True, inferSchema=False, quote='"', escape='"', multiLine=True, mode="FAILFAST").csv(path)


def with_lineage(
    rows: DataFrame, namespace: str, release: str, file_id: str, content: Sequence[Column], member: str, run_id: str, contract: str, loaded_at, version: str = "v1", parent: str | None = None
) -> DataFrame:
    """The nine lineage columns before the raw ones; a row's key names its content (columns before its number), not the load."""
    key = stable_sha256(namespace, version, *content, F.col("source_row_number"))
    lineage = {
        "source_record_key": key, "dataset_release_id": F.lit(release), "source_file_id": F.lit(file_id), "parent_source_file_id": F.lit(parent).cast("string"), "source_member_path": F.lit(member),
        "source_row_number": F.col("source_row_number"), "pipeline_run_id": F.lit(run_id), "parser_contract_version": F.lit(contract), "loaded_at": F.lit(loaded_at),
    }
    raw = [c for c in rows.columns if c != "source_row_number"]
    return rows.select(*(c.alias(n) for n, c in lineage.items()), *raw)


def raw_names(path: str) -> list[str]:
    return snake_header(read_header(path))


def check_columns(df: DataFrame, expected: Sequence[str]) -> None:
    if tuple(df.columns) != tuple(expected):
        raise HeaderDrift(f"table columns {df.columns} instead of {list(expected)}")


def write_ordered(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """A bounded report as one headed file in order."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").csv(path, header=True)
