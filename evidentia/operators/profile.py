"""Natural-key conflict classes, representatives, reference profiles, checksums and fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.functions.keys import checksum


def conflict_class(count: Column, distinct: Column) -> Column:
    return F.when(count == 1, "UNIQUE").when(distinct == 1, "EXACT_DUPLICATE").otherwise("CONFLICT")


def _hashed(df: DataFrame, key: Sequence[str], payload: Column) -> DataFrame:
    """Keys with 128 bits of their rows' payloads; a NULL payload is a value of its own."""
    seen = F.coalesce(F.concat(F.lit("V"), payload.cast("string")), F.lit("N"))
    return df.select(*key, F.xxhash64(seen).alias("__a"), F.xxhash64(F.lit(1), seen).alias("__b"))


def natural_key_classes(df: DataFrame, key: Sequence[str], payload: Column) -> DataFrame:
    """Per key: rows, distinct payloads and the conflict class. NULL payloads count as one value."""
    found = _hashed(df, key, payload).groupBy(*key).agg(F.count("*").alias("row_count"), F.countDistinct("__a", "__b").alias("distinct_payloads"))
    return found.withColumn("conflict_status", conflict_class(F.col("row_count"), F.col("distinct_payloads")))


def conflict_classes(df: DataFrame, key: Sequence[str], payload: Column) -> DataFrame:
    """Per key: rows and the conflict class alone.

    The two extremes tell one payload from several, so rows combine before the only shuffle, however many a key has.
    """
    ends = [f(c).alias(f"{n}{c}") for c in ("__a", "__b") for n, f in (("min", F.min), ("max", F.max))]
    found = _hashed(df, key, payload).groupBy(*key).agg(F.count("*").alias("row_count"), *ends)
    one = (F.col("min__a") == F.col("max__a")) & (F.col("min__b") == F.col("max__b"))
    return found.select(*key, "row_count", conflict_class(F.col("row_count"), F.when(one, 1).otherwise(2)).alias("conflict_status"))


def classify_rows(df: DataFrame, key: Sequence[str], payload: Column) -> DataFrame:
    """df with each row's key count and class."""
    return df.join(conflict_classes(df, key, payload), list(key))


def representatives(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in an order that leaves no ties."""
    least = F.min(F.struct(*order, F.struct(*(F.col(c).alias(c) for c in df.columns)).alias("__row"))).alias("__least")
    return df.groupBy(*key).agg(least).select("__least.__row.*")


def min_by_known(value: Column, by: Column) -> Column:
    """Value at the least `by` among rows where the value is not NULL."""
    return F.min_by(value, F.when(value.isNotNull(), by))


def reference_profile(df: DataFrame, code: str, parts: Sequence[str], order: Column) -> DataFrame:
    """Per code: rows, distinct representations (NULLs count) and each part at the least order where it is known."""
    distinct = F.countDistinct(F.struct(*parts))
    shown = [min_by_known(F.col(p), order).alias(p) for p in parts]
    found = df.groupBy(code).agg(F.count("*").alias("row_count"), distinct.alias("distinct_representations"), *shown)
    return found.withColumn("conflict_status", conflict_class(F.col("row_count"), F.col("distinct_representations")))


def population_checksum(df: DataFrame, key: Column) -> DataFrame:
    """One row: count, least and greatest key, checksum."""
    return df.agg(F.count("*").alias("row_count"), F.min(key).alias("min_key"), F.max(key).alias("max_key"), checksum(key).alias("key_checksum"))


def ordered_fingerprint(df: DataFrame, value: str, separator: str = "|") -> DataFrame:
    """SHA-256 over all values in order; for small control tables."""
    return df.agg(F.sha2(F.expr(f"listagg({value}, '{separator}') WITHIN GROUP (ORDER BY {value})"), 256).alias("fingerprint"))


def with_count(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    return df.withColumn(name, F.count("*").over(Window.partitionBy(*key)))
