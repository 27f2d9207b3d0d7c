"""Fatal rules: accepted rows, quarantine events, reconciliation and checks that return what violates them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions.keys import stable_sha256


@dataclass(frozen=True)
class Rule:
    """A row for which `fails` holds is not accepted."""

    code: str
    fails: str


def _broken(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a | b, (F.coalesce(F.expr(r.fails), F.lit(False)) for r in rules))


def accepted(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.filter(~_broken(rules))


def quarantine(df: DataFrame, key: Column, rules: Sequence[Rule], raw: Sequence[str]) -> DataFrame:
    """An event for each rule that a row breaks, from one scan; `raw` is kept as JSON with its NULLs."""
    events = F.array_compact(F.array(*(F.when(F.coalesce(F.expr(r.fails), F.lit(False)), F.lit(r.code)) for r in rules)))
    found = df.filter(_broken(rules)).select(
        key.cast("string").alias("record_key"), F.explode(events).alias("rule_code"), F.to_json(F.struct(*raw), {"ignoreNullFields": "false"}).alias("raw_record")
    )
    return found.withColumn("quarantine_key", stable_sha256("quarantine", "v1", "record_key", "rule_code"))


def reconcile(observed: DataFrame, accepted_rows: DataFrame, events: DataFrame, group: str) -> DataFrame:
    """Per group: rows observed, accepted and quarantined (each once), PASSED if they add up. Groups of either side show."""
    left = observed.groupBy(group).agg(F.count("*").alias("observed_count"))
    mid = accepted_rows.groupBy(group).agg(F.count("*").alias("accepted_count"))
    right = events.groupBy(group).agg(F.countDistinct("record_key").alias("quarantined_count"))
    both = left.join(mid, group, "full").join(right, group, "full").fillna(0, ["observed_count", "accepted_count", "quarantined_count"])
    same = F.col("observed_count") == F.col("accepted_count") + F.col("quarantined_count")
    return both.withColumn("reconciliation_status", F.when(same, "PASSED").otherwise("FAILED"))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def closure(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys on one side only."""
    missing = expected.select(key).join(found.select(key), key, "left_anti").withColumn("violation", F.lit("MISSING"))
    orphan = found.select(key).join(expected.select(key), key, "left_anti").withColumn("violation", F.lit("ORPHAN"))
    return missing.unionByName(orphan)


def disjoint(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).join(b.select(key), key, "left_semi")


def forbidden_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c.lower() in {n.lower() for n in names}]


def interval_violations(df: DataFrame, key: str) -> DataFrame:
    """Ledger rows that end before they begin, or are open without being current, and keys with several current rows."""
    shape = df.filter((F.col("valid_to") < F.col("valid_from")) | (F.col("is_current") != F.col("valid_to").isNull())).select(key)
    several = df.filter("is_current").groupBy(key).count().filter("count > 1").select(key)
    return shape.unionByName(several).distinct()


def wrong_keys(df: DataFrame, key: str, expected: Column) -> DataFrame:
    """Rows whose stored key is not the one computed anew."""
    return df.filter(~F.col(key).eqNullSafe(expected)).select(F.col(key).alias("stored_key"), expected.alias("expected_key"))


def gating_violations(df: DataFrame, key: str, status: str, rules: dict[str, tuple[Sequence[str], Sequence[str]]]) -> DataFrame:
    """Rows whose status does not go with their columns: rules give, by status, those that must be NULL and those that must not."""
    broken: Column = ~F.col(status).isin(*rules) | F.col(status).isNull()
    for value, (empty, filled) in rules.items():
        wrong = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in empty] + [F.col(c).isNull() for c in filled], F.lit(False))
        broken = broken | ((F.col(status) == value) & wrong)
    return df.filter(broken).select(key, status)


def unequal_totals(totals: dict[str, DataFrame], same: Sequence[Sequence[str]]) -> DataFrame:
    """Groups of one-row counts that ought to be equal and are not: a row for each, with all counts as JSON."""
    one = reduce(lambda a, b: a.crossJoin(b), (df.toDF(name) for name, df in totals.items()))
    rows = [F.struct(F.lit(",".join(group)).alias("totals"), F.greatest(*group).alias("most"), F.least(*group).alias("least")) for group in same]
    return one.select(F.inline(F.array(*rows))).filter("most <> least")


def closed_population(a: DataFrame, b: DataFrame, key: Column) -> DataFrame:
    """Whether two populations have the same keys, by count and checksum: one row, `closed` true or false."""
    from evidentia.operators.profile import population_checksum

    left, right = population_checksum(a, key), population_checksum(b, key)
    columns = ("row_count", "min_key", "max_key", "key_checksum")
    both = left.toDF(*(f"a_{c}" for c in columns)).crossJoin(right.toDF(*(f"b_{c}" for c in columns)))
    same = reduce(lambda x, y: x & y, (F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in columns))
    return both.select(F.col("a_row_count").alias("expected_count"), F.col("b_row_count").alias("found_count"), same.alias("closed"))
