"""Core facts: children by parent, aggregates with empty parents, locations, centroids, coordinate requests."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.operators.store import append_if_absent, exists, read, stage


def parent_status(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """children with ORPHAN, CONFLICTING or MATCHED, from parents (key, conflict_status)."""
    found = parents.groupBy(key).agg(F.count("*").alias("parent_count"), F.count_if(F.col("conflict_status") == "CONFLICT").alias("__bad"))
    status = F.when(F.col("parent_count").isNull(), "ORPHAN").when(F.col("__bad") > 0, "CONFLICTING").otherwise("MATCHED")
    return children.join(found, key, "left").withColumn("parent_status", status).drop("__bad").fillna(0, ["parent_count"])


def aggregate_all_parents(parents: DataFrame, children: DataFrame, key: str, measures: dict[str, Column], zero: Sequence[str]) -> DataFrame:
    """A row for every parent; counts of a parent without children are 0, other measures NULL."""
    return parents.join(children.groupBy(key).agg(*(c.alias(n) for n, c in measures.items())), key, "left").fillna(0, list(zero))


def centroids(points: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Centre of a group's distinct points, their number and the diagonal of their bounding box."""
    distinct = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(group, x, y).distinct()
    spread = F.sqrt(F.pow(F.max(x) - F.min(x), 2) + F.pow(F.max(y) - F.min(y), 2))
    return distinct.groupBy(group).agg(F.count("*").alias("point_count"), F.avg(x).alias("centre_x"), F.avg(y).alias("centre_y"), spread.alias("spread"))


def contract_requests(requests: Sequence[tuple[str, DataFrame]], x: str, y: str) -> DataFrame:
    """Distinct points that several sources ask for, with flags and the sorted list of sources."""
    tagged = [df.select(x, y, F.lit(name).alias("method")) for name, df in requests]
    union = tagged[0]
    for t in tagged[1:]:
        union = union.unionByName(t)
    flags = {f"is_{name.lower()}": F.bool_or(F.col("method") == name) for name, _ in requests}
    out = union.groupBy(x, y).agg(F.count("*").alias("request_count"), *(c.alias(n) for n, c in flags.items()))
    methods = F.array_compact(F.array(*(F.when(F.col(f"is_{name.lower()}"), F.lit(name)) for name, _ in requests)))
    return out.withColumn("methods", F.array_join(methods, ","))


def located(required: DataFrame, allocations: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Each required key: one allocation, none, or several that differ; values show only for one."""
    kinds = F.countDistinct(F.struct(*values))
    found = allocations.groupBy(key).agg(kinds.alias("allocation_count"), *(F.min(v).alias(v) for v in values))
    n = F.coalesce(F.col("allocation_count"), F.lit(0))
    out = required.select(key).distinct().join(found, key, "left").withColumn("allocation_count", n)
    out = out.withColumn("location_status", F.when(n == 0, "MISSING_IN_RELEASE").when(n == 1, "RESOLVED_UNIQUE").otherwise("CONFLICTING_ALLOCATIONS"))
    return out.withColumns({v: F.when(F.col("location_status") == "RESOLVED_UNIQUE", F.col(v)) for v in values})


def transform_once(requests: DataFrame, path: str, key: str, transform: Callable[[DataFrame], DataFrame]) -> int:
    """Add to the table at path what transform makes of the requests whose key it has not; how many were new.

    A value is transformed once, whoever asks for it again.
    """
    spark = requests.sparkSession
    wanted = requests.dropDuplicates([key])
    if exists(spark, path):
        wanted = wanted.join(read(spark, path).select(key), key, "left_anti")
    made = stage(transform(wanted), "transformed")
    append_if_absent(made, path, [key])
    return made.count()
