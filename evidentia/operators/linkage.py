"""Record linkage: block profiles, candidate pairs, Fellegi-Sunter weights and their training, review decisions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRIOR = 0.000001


def block_profile(df: DataFrame, block: Sequence[str], side: str, left: str, right: str, side_cap: int, product_cap: int) -> DataFrame:
    """Per block with both sides: counts, product, and ADMIT or SUPPRESS by the caps."""
    counts = df.groupBy(*block).agg(F.count_if(F.col(side) == left).alias("left_count"), F.count_if(F.col(side) == right).alias("right_count"))
    product = F.col("left_count").cast("decimal(20,0)") * F.col("right_count").cast("decimal(18,0)")
    small = (F.greatest("left_count", "right_count") <= side_cap) & (F.col("pair_product") <= product_cap)
    both = counts.filter("left_count > 0 AND right_count > 0").withColumn("pair_product", product.cast("long"))
    return both.withColumn("admission", F.when(small, "ADMIT").otherwise("SUPPRESS"))


def self_block_sizes(df: DataFrame, block: Sequence[str]) -> DataFrame:
    """Block sizes and the pairs each would give."""
    n = F.col("block_size")
    return df.groupBy(*block).agg(F.count("*").alias("block_size")).withColumn("pair_count", (n * (n - 1) / 2).cast("long"))


def self_pairs(df: DataFrame, block: Sequence[str], key: str, most: int | None = None) -> DataFrame:
    """Pairs (key_l < key_r) within equal, known blocks. Profile the blocks first and drop those over their cap.

    most: split blocks with more rows among several tasks.
    """
    left = df.select(F.col(key).alias("key_l"), *block).dropna(subset=list(block))
    right = df.select(F.col(key).alias("key_r"), *block).dropna(subset=list(block))
    on = list(block)
    if most:
        left, right = split_blocks(left, right, block, "key_l", most)
        on.append("__part")
    return left.join(right, on).filter("key_l < key_r").select(*block, "key_l", "key_r")


def cross_pairs(left: DataFrame, right: DataFrame, block: Sequence[str], residual: Column | None = None) -> DataFrame:
    """Pairs of two sources that share the block; a residual condition may follow."""
    pairs = left.join(right, list(block))
    return pairs if residual is None else pairs.filter(residual)


def split_blocks(left: DataFrame, right: DataFrame, block: Sequence[str], key: str, most: int, other: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with `__part`, to be joined on besides the block: a block with more than `most` rows on the right is dealt
    among several tasks. Its left rows stand in one part each, by the hash of their key, its right rows in all.

    other: the right rows' key, by which they are dealt too: the parts form a square, and a row stands in one line of it. A
    block is copied by the root of its parts then.

    Only blocks above `most` are listed, so that list is a small share of the rows; it is broadcast where it is.
    """
    large = right.groupBy(*block).agg(F.count("*").alias("__n")).filter(F.col("__n") > most).select(*block, F.ceil(F.col("__n") / most).cast("int").alias("__parts"))
    parts = F.coalesce("__parts", F.lit(1))
    if other:
        side = F.ceil(F.sqrt(parts)).cast("int")
        place = lambda c: F.pmod(F.xxhash64(c), side.cast("long")).cast("int")
        mine = left.join(large, list(block), "left").withColumn("__part", F.explode(F.sequence(place(key) * side, place(key) * side + side - 1))).drop("__parts")
        theirs = right.join(large, list(block), "left").withColumn("__part", F.explode(F.sequence(place(other), place(other) + side * (side - 1), side))).drop("__parts")
        return mine, theirs
    mine = left.join(large, list(block), "left").withColumn("__part", F.pmod(F.xxhash64(key), parts.cast("long")).cast("int")).drop("__parts")
    theirs = right.join(large, list(block), "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return mine, theirs


#: Tasks among which pairs are dealt at least, however small the rows behind them are.
PAIR_TASKS = 256


def dealt_pairs(left: DataFrame, right: DataFrame, block: Sequence[str], key: str, most: int = 2048, tasks: int = PAIR_TASKS, other: str | None = None) -> DataFrame:
    """Pairs of two sources that share a known block, with `__part`: blocks are split as in `split_blocks`.

    Both sides are dealt by block and part into a given number of tasks, which is not lessened for small rows: the work
    is that of the pairs.
    """
    on = [*block, "__part"]
    mine, theirs = split_blocks(left.dropna(subset=list(block)), right.dropna(subset=list(block)), block, key, most, other)
    return mine.repartition(tasks, *on).join(theirs.repartition(tasks, *on), on)


@dataclass(frozen=True)
class Level:
    """An agreement level: a condition over the pair, its probabilities among matches and non-matches."""

    name: str
    condition: str
    m: float
    u: float


@dataclass(frozen=True)
class Comparison:
    """Levels in order, the first that holds counts; NULL on either side is neutral. An ELSE level closes the list."""

    name: str
    null: str
    levels: tuple[Level, ...]

    def level(self) -> Column:
        out = F.when(F.expr(self.null), "NULL")
        for x in self.levels[:-1]:
            out = out.when(F.expr(x.condition), x.name)
        return out.otherwise(self.levels[-1].name)

    def weight(self) -> Column:
        """log2 of the Bayes factor."""
        out = F.when(F.expr(self.null), F.lit(0.0))
        for x in self.levels[:-1]:
            out = out.when(F.expr(x.condition), math.log2(x.m / x.u))
        return out.otherwise(math.log2(self.levels[-1].m / self.levels[-1].u))


def term_frequency_weight(agrees: Column, u: float, tf_l: Column, tf_r: Column) -> Column:
    """What an exact agreement on a value of this frequency adds."""
    return F.when(agrees & tf_l.isNotNull() & tf_r.isNotNull(), F.log2(F.lit(u) / F.greatest(tf_l, tf_r))).otherwise(0.0)


def term_frequencies(df: DataFrame, value: str) -> DataFrame:
    total = df.filter(F.col(value).isNotNull()).agg(F.count("*").alias("__n"))
    return df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("__c")).crossJoin(F.broadcast(total)).select(value, (F.col("__c") / F.col("__n")).alias("tf"))


def score(pairs: DataFrame, comparisons: Sequence[Comparison], prior: float = PRIOR, extra: Column | None = None) -> DataFrame:
    """pairs with gamma_<name>, bf_<name>, match_weight and match_probability."""
    parts = {f"gamma_{c.name}": c.level() for c in comparisons} | {f"bf_{c.name}": c.weight() for c in comparisons}
    out = pairs.withColumns(parts)
    weight = F.lit(math.log2(prior / (1 - prior)))
    for c in comparisons:
        weight = weight + F.col(f"bf_{c.name}")
    out = out.withColumn("match_weight", weight if extra is None else weight + extra)
    return out.withColumn("match_probability", 1 / (1 + F.pow(F.lit(2.0), -F.col("match_weight"))))


def score_rounded(pairs: DataFrame, comparisons: Sequence[Comparison], prior: float = PRIOR, digits: int = 6) -> DataFrame:
    """pairs with gamma_<name>, match_weight, rounded, as `score` finds it, and match_probability (nine digits) by that weight.

    A weight depends on the levels alone, so all weights are worked out once and looked up by the levels' numbers.
    """
    numbers, names, weights = {}, {}, [math.log2(prior / (1 - prior))]
    for c in comparisons:
        number = F.when(F.expr(c.null), 0)
        for k, x in enumerate(c.levels[:-1], 1):
            number = number.when(F.expr(x.condition), k)
        numbers[f"__{c.name}"] = number.otherwise(len(c.levels))
        names[f"gamma_{c.name}"] = F.get(F.array(F.lit("NULL"), *(F.lit(x.name) for x in c.levels)), F.col(f"__{c.name}"))
        weights = [w + v for w in weights for v in (0.0, *(math.log2(x.m / x.u) for x in c.levels))]
    place = F.lit(0)
    for c in comparisons:
        place = place * (len(c.levels) + 1) + F.col(f"__{c.name}")
    rounded = [F.round(F.lit(w), digits) for w in weights]
    found = {"match_weight": F.get(F.array(*rounded), place), "match_probability": F.get(F.array(*(F.round(1 / (1 + F.pow(F.lit(2.0), -w)), 9) for w in rounded)), place)}
    return pairs.withColumns(numbers).withColumns(names | found).drop(*numbers)


def random_pair_sample(df: DataFrame, key: str, most_pairs: int, seed: int = 42) -> DataFrame:
    """Rows picked by hash so that all their pairs number about most_pairs."""
    n = df.count()
    wanted = (1 + math.isqrt(1 + 8 * most_pairs)) // 2
    share = 1.0 if n <= wanted else wanted / n
    return df.filter(F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) < int((1 << 30) * share))


def estimate_u(pairs: DataFrame, comparisons: Sequence[Comparison]) -> dict[str, dict[str, float]]:
    """Share of each level among random pairs, neutral ones aside."""
    names, out = [c.name for c in comparisons], {}
    patterns = pairs.select(*(c.level().alias(c.name) for c in comparisons)).groupBy(*names).agg(F.count("*").alias("n")).collect()
    for c in comparisons:
        counts: dict[str, int] = {}
        for r in patterns:
            if r[c.name] != "NULL":
                counts[r[c.name]] = counts.get(r[c.name], 0) + r.n
        total = sum(counts.values())
        out[c.name] = {x.name: max(counts.get(x.name, 0), 0.5) / max(total, 1) for x in c.levels}
    return out


def estimate_m(pairs: DataFrame, comparisons: Sequence[Comparison], u: dict[str, dict[str, float]], start: float, iterations: int = 15, tolerance: float = 1e-4, patterns: DataFrame | None = None) -> tuple[dict[str, dict[str, float]], float, int]:
    """Expectation maximisation over the counts of agreement patterns, of which there are few whatever the pairs.

    patterns: these counts (a column a comparison, and n) where they are known; pairs are not made then.
    """
    names = [c.name for c in comparisons]
    if patterns is None:
        patterns = pairs.select(*(c.level().alias(c.name) for c in comparisons)).groupBy(*names).agg(F.count("*").alias("n"))
    patterns = patterns.collect()
    m = {c.name: {x.name: x.m for x in c.levels} for c in comparisons}
    prior = start
    for done in range(1, iterations + 1):
        sums = {c.name: dict.fromkeys(m[c.name], 1e-9) for c in comparisons}
        matches = total = 0.0
        for row in patterns:
            yes, no = prior, 1 - prior
            for name in names:
                if row[name] != "NULL":
                    yes, no = yes * m[name][row[name]], no * u[name][row[name]]
            p = yes / (yes + no)
            matches, total = matches + p * row.n, total + row.n
            for name in names:
                if row[name] != "NULL":
                    sums[name][row[name]] += p * row.n
        new = {name: {k: v / sum(s.values()) for k, v in s.items()} for name, s in sums.items()}
        moved = max(abs(new[a][b] - m[a][b]) for a in m for b in m[a])
        m, prior = new, min(max(matches / max(total, 1), 1e-12), 1 - 1e-12)
        if moved < tolerance:
            break
    return m, prior, done


def decisions(scored: DataFrame, direct: Column, agrees: Column, medium: Column) -> DataFrame:
    """Every pair goes to review; direct identifiers that disagree elsewhere come first."""
    # Reasons and priorities.
    reason = F.when(direct & ~agrees, "UNCALIBRATED_DIRECT_IDENTIFIER_HETEROGENEOUS").when(direct, "UNCALIBRATED_DIRECT_IDENTIFIER_CONSISTENT").otherwise("UNCALIBRATED_PROBABILISTIC_MODEL")
    priority = F.when(direct & ~agrees, "HIGH").when(medium, "MEDIUM").otherwise("STANDARD")
    return scored.withColumns({"decision_outcome": F.lit("REVIEW"), "decision_reason": reason, "review_priority": priority, "is_accepted_edge": F.lit(False)})


def endpoints(pairs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Two rows a pair: each end with its counterpart."""
    ends = F.array(F.struct(F.col("key_l").alias("key"), F.col("key_r").alias("other")), F.struct(F.col("key_r").alias("key"), F.col("key_l").alias("other")))
    return pairs.select(F.explode(ends).alias("e"), *keep).select("e.key", "e.other", *keep)


def alternatives(pairs: DataFrame, weight: str = "match_weight") -> DataFrame:
    """Each end's counterparts by rank, with the margin to the next."""
    return ranked_alternatives(endpoints(pairs, [weight]), [], weight)


def ranked_alternatives(ends: DataFrame, dealt_by: Sequence[str], weight: str = "match_weight") -> DataFrame:
    """Ends (key, other, weight) by rank. dealt_by: columns that hold all of a key's rows together, if rows are dealt by these already."""
    w = Window.partitionBy(*dealt_by, "key").orderBy(F.col(weight).desc(), F.col("other"))
    return ends.withColumns({"alternative_rank": F.row_number().over(w), "margin_to_next": F.col(weight) - F.lead(weight).over(w)})


def endpoint_summary(pairs: DataFrame, weight: str = "match_weight") -> DataFrame:
    """Per end: counterparts, best weight and its counterpart (the smallest of equals)."""
    best = F.max_by("other", F.struct(F.col(weight), -F.col("other")))
    return endpoints(pairs, [weight]).groupBy("key").agg(F.count("*").alias("candidate_count"), F.max(weight).alias("top_weight"), best.alias("top_other"))


def target_alternatives(pairs: DataFrame, targets: DataFrame, weight: str = "match_weight") -> DataFrame:
    """Per end and target of its counterparts (targets: other, target): members, best weight, rank, number of targets, margin."""
    return ranked_targets(endpoints(pairs, [weight]).join(targets, "other").groupBy("key", "target").agg(F.count("*").alias("member_count"), F.max(weight).alias("top_weight")))


def ranked_targets(grouped: DataFrame) -> DataFrame:
    """Each end's targets by top_weight."""
    w = Window.partitionBy("key").orderBy(F.col("top_weight").desc(), F.col("target"))
    return grouped.withColumns({"target_rank": F.row_number().over(w), "target_count": F.count("*").over(Window.partitionBy("key")), "margin_to_next": F.col("top_weight") - F.lead("top_weight").over(w)})


def hypotheses(population: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every member of the population (key) with its candidates counted; those without any are singletons."""
    return counted_hypotheses(population, endpoints(pairs, []).groupBy("key").agg(F.count("*").alias("candidate_count")))


def counted_hypotheses(population: DataFrame, counts: DataFrame) -> DataFrame:
    out = population.select("key").join(counts, "key", "left").fillna(0, ["candidate_count"])
    return out.withColumn("hypothesis_type", F.when(F.col("candidate_count") == 0, "SINGLETON_NO_CANDIDATE").otherwise("UNRESOLVED_REVIEW"))


def identifier_heterogeneity(df: DataFrame, identifier: str, address: str, others: Sequence[str]) -> DataFrame:
    """One row: how many identifiers have several addresses or other values, and how many of their pairs agree on the address.

    Rows are first counted by identifier and address, so no identifier's pairs are ever made.
    """
    known = df.filter(F.col(identifier).isNotNull())
    by_address = known.groupBy(identifier, address).agg(F.count("*").alias("n"), *(F.collect_set(c).alias(c) for c in others))
    several = {c: F.size(F.array_distinct(F.flatten(F.collect_list(c)))).alias(f"{c}_count") for c in others}
    half = lambda n: (F.col(n) * (F.col(n) - 1) / 2).cast("long")
    groups = by_address.groupBy(identifier).agg(F.sum("n").alias("size"), F.count_if(F.col(address).isNotNull()).alias("address_count"), F.sum(half("n")).alias("exact_pairs"), *several.values())
    whole = half("size")
    return groups.agg(
        F.count("*").alias("identifier_groups"), F.sum("size").alias("observations"), F.max("size").alias("maximum_group_size"), F.percentile("size", 0.5).alias("median_group_size"), F.percentile("size", 0.99).alias("p99_group_size"),
        F.count_if(F.col("address_count") > 1).alias("groups_with_multiple_addresses"), *(F.count_if(F.col(f"{c}_count") > 1).alias(f"groups_with_multiple_{c}") for c in others),
        F.sum(whole).alias("all_pairs"), F.sum("exact_pairs").alias("exact_address_pairs"), F.sum(whole - F.col("exact_pairs")).alias("discordant_address_pairs"),
    )
