"""Deterministic samples, label import and threshold evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.operators.store import stage


def seeded(seed: str, key: Column) -> Column:
    return F.sha2(F.concat(F.lit(seed), F.lit("|"), key.cast("string")), 256)


def prefix_sample(df: DataFrame, key: Column, share_of_256: int) -> DataFrame:
    """Rows whose key hashes into the first so many of 256 parts."""
    return df.filter(F.substring(F.sha2(key.cast("string"), 256), 1, 2) < f"{share_of_256:02x}") if share_of_256 < 256 else df


def top_sample(df: DataFrame, key: Column, seed: str, n: int) -> DataFrame:
    return df.orderBy(seeded(seed, key)).limit(n)


def quota_sample(df: DataFrame, strata: Sequence[str], key: Column, seed: str, quota: int) -> DataFrame:
    """The first rows of each stratum in a seeded order."""
    w = Window.partitionBy(*strata).orderBy(seeded(seed, key))
    return df.withColumn("sample_rank", F.row_number().over(w)).filter(F.col("sample_rank") <= quota)


def latest(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("__rank = 1").drop("__rank")


def import_labels(current: DataFrame, new: DataFrame, sampled: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """Labels after an import: each new one supersedes the row's active one. Unknown rows and words are errors."""
    if not new.filter(F.col("label").isNull() | ~F.col("label").isin(*vocabulary)).isEmpty():
        raise ValueError("labels outside the vocabulary")
    if not new.join(sampled.select("sample_id"), "sample_id", "left_anti").isEmpty():
        raise ValueError("labels for rows that were not sampled")
    hit = new.select("sample_id", F.lit(True).alias("__new"))
    old = current.join(hit, "sample_id", "left").withColumn("is_active", F.col("is_active") & F.col("__new").isNull()).drop("__new")
    return old.unionByName(new.withColumn("is_active", F.lit(True)), allowMissingColumns=True)


def threshold_sweep(labelled: DataFrame, weight: str, truth: str, first: int = -20, last: int = 40) -> DataFrame:
    """Confusion counts and rates at every whole threshold.

    A row is at or above all thresholds up to the floor of its weight, so rows are counted by that, clipped to the range,
    and the counts of a few dozen steps are added up from the top.
    """
    step = F.least(F.greatest(F.floor(weight).cast("long"), F.lit(first - 1)), F.lit(last)).alias("threshold")
    yes = F.col(truth)
    counted = labelled.filter(F.col(weight).isNotNull()).groupBy(step).agg(F.count_if(yes).alias("__yes"), F.count_if(~yes).alias("__no"))
    every = labelled.sparkSession.range(first - 1, last + 1).withColumnRenamed("id", "threshold")
    steps = every.join(F.broadcast(counted), "threshold", "left").fillna(0, ["__yes", "__no"])
    above = Window.orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    below = Window.orderBy("threshold").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    counts = steps.select(
        "threshold", F.sum("__yes").over(above).alias("true_positive"), F.sum("__no").over(above).alias("false_positive"),
        F.coalesce(F.sum("__yes").over(below), none).alias("false_negative"), F.coalesce(F.sum("__no").over(below), none).alias("true_negative"),
    ).filter(F.col("threshold") >= first)
    ratio = lambda a, b: F.col(a) / F.nullif(F.col(a) + F.col(b), F.lit(0))
    rates = counts.withColumns({"precision": ratio("true_positive", "false_positive"), "recall": ratio("true_positive", "false_negative"), "specificity": ratio("true_negative", "false_positive")})
    return rates.withColumn("f1_score", 2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0)))


def evaluate(labelled: DataFrame, weight: str, truth: str, least: int = 100) -> DataFrame:
    n, yes = labelled.agg(F.count("*"), F.count_if(truth)).first()
    if n < least or yes in (0, n):
        raise ValueError(f"{n} labels, {yes} matches: {least} labels of both classes are needed")
    return threshold_sweep(labelled, weight, truth)


def rule_versions(rows: DataFrame, versions: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """rows with an empty rule version filled from the version in force for their rule; set ones stay."""
    known = versions.select(*key, F.col(column).alias("__version"))
    return rows.join(F.broadcast(known), list(key), "left").withColumn(column, F.coalesce(column, "__version")).select(*rows.columns)


#: Letters by which a street's places in a premise are found.
OPENING = 4


def weak_label_sample(rows: DataFrame, sales: DataFrame, seed: str, n: int) -> DataFrame:
    """Certificates whose unit, house number and street are told by a sale of the same postcode, one sale each.

    rows: key, postcode, premise, numbers (its number tokens in order). sales: sale_key, postcode, paon, saon, street.
    Of several sales the first by hash is taken; the number of rows that have one stands beside each. A street is told if the
    premise contains it: the parts of the premise that begin as some street does, of that street's length, are looked up
    among the streets of the same postcode, unit and number, of each of which one sale is kept. No pairs are made.
    """
    token = lambda c: F.regexp_extract(F.upper(c), "(^| )([0-9]+[A-Z]?)", 2)
    told = sales.select("sale_key", "postcode", token("saon").alias("u"), token("paon").alias("h"), "paon", "saon", "street", F.upper("street").alias("s"))
    asked = rows.select("key", "postcode", "premise", F.get("numbers", F.lit(0)).alias("u"), F.get("numbers", F.lit(1)).alias("h"))
    block = ["postcode", "u", "h", "s"]
    first = F.min(F.struct(F.sha2("sale_key", 256).alias("r"), "sale_key", "paon", "saon", "street"))
    told = stage(told.groupBy(*block).agg(first.alias("x")).filter("s IS NOT NULL"), "told-streets")
    # Streets' openings of up to OPENING letters, with the lengths of the streets that begin so.
    opening = F.left(F.col("s"), F.lit(OPENING))
    openings = told.groupBy(opening.alias("opening")).agg(F.collect_set(F.length("s")).alias("lengths"))
    openings = F.broadcast(openings) if openings.count() <= 100_000 else openings
    places = asked.filter("premise IS NOT NULL").select("*", F.explode(F.sequence(F.lit(1), F.greatest(F.length("premise"), F.lit(1)))).alias("at"))
    begun = places.select("*", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.substring("premise", F.col("at"), F.lit(k)).alias("opening")) for k in range(OPENING + 1)))).alias("o"))
    begun = begun.filter("length(o.opening) = o.k").select("key", "postcode", "u", "h", "premise", "at", F.col("o.opening").alias("opening")).join(openings, "opening")
    parts = begun.select("key", "postcode", "u", "h", F.col("premise"), "at", F.explode("lengths").alias("n")).filter("at + n - 1 <= length(premise)")
    parts = parts.select("key", "postcode", "u", "h", F.expr("substring(premise, at, n)").alias("s")).distinct()
    one = parts.join(told, block).groupBy("key").agg(F.min("x").alias("x"))
    total = one.agg(F.count("*").alias("weak_label_population_count"))
    picked = one.orderBy(seeded(seed, F.col("key"))).limit(n)
    return picked.crossJoin(F.broadcast(total)).select("key", "x.sale_key", F.col("x.paon").alias("expected_house_number"), F.col("x.saon").alias("expected_unit"), F.col("x.street").alias("expected_road"), "weak_label_population_count")


def _band(value: Column, limits: Sequence[tuple[int, str]], last: str, strict: bool = False) -> Column:
    out = F.when(F.lit(False), "")
    for limit, name in limits:
        out = out.when(value < limit if strict else value <= limit, name)
    return out.otherwise(last)


def calibration_rows(decided: DataFrame, summary: DataFrame, ambiguity: DataFrame) -> DataFrame:
    """Pairs with what both ends know, in bands: score, fan-out (the larger of both ends), ambiguity (targets), agreement.

    decided: key_l, key_r, candidate_pair_key, match_weight, review_priority and the comparison levels. summary: key,
    candidate_count. ambiguity: key, target_count. Each end joins both, so a pair meets four small rows.
    """
    out = decided
    for side in "lr":
        ends = summary.select(F.col("key").alias(f"key_{side}"), F.col("candidate_count").alias(f"fan_out_{side}"))
        targets = ambiguity.select(F.col("key").alias(f"key_{side}"), F.col("target_count").alias(f"targets_{side}"))
        out = out.join(ends, f"key_{side}").join(targets, f"key_{side}")
    # The limits of the bands.
    score = _band(F.col("match_weight"), ((0, "BELOW_0"), (10, "0_TO_10"), (20, "10_TO_20"), (30, "20_TO_30")), "30_AND_ABOVE", strict=True)
    fan_out = _band(F.greatest("fan_out_l", "fan_out_r"), ((1, "1"), (5, "2_TO_5"), (20, "6_TO_20")), "ABOVE_20")
    targets = _band(F.greatest("targets_l", "targets_r"), ((1, "1"), (3, "2_TO_3")), "ABOVE_3")
    agreement = F.concat_ws("+", F.when(F.col("postcode_comparison_level") == "EXACT", "POSTCODE"), F.when(F.col("premise_address_comparison_level") == "EXACT", "PREMISE"))
    return out.select("candidate_pair_key", "review_priority", score.alias("score_band"), fan_out.alias("fan_out_band"), targets.alias("ambiguity_band"), agreement.alias("agreement"))
