"""Jaro-Winkler similarity, Arrow-batched; meant for pairs that cheaper levels have not decided."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: The prefix counts up to so many characters, each for so much, above this plain similarity.
PREFIX, WEIGHT, BOOST_ABOVE = 4, 0.1, 0.7


def jaro(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(len(a), len(b)) // 2 - 1
    taken = [False] * len(b)
    mine = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                mine.append(c)
                break
    if not mine:
        return 0.0
    theirs = [c for c, t in zip(b, taken, strict=True) if t]
    moved = sum(x != y for x, y in zip(mine, theirs, strict=True)) // 2
    m = len(mine)
    return (m / len(a) + m / len(b) + (m - moved) / m) / 3


def jaro_winkler_of(a: str, b: str) -> float:
    plain = jaro(a, b)
    if plain <= BOOST_ABOVE:
        return plain
    same = 0
    for x, y in zip(a[:PREFIX], b[:PREFIX], strict=False):
        if x != y:
            break
        same += 1
    return plain + same * WEIGHT * (1 - plain)


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """NULL where either is NULL; equal pairs of a batch are compared once."""
    known: dict = {}
    out = []
    for pair in zip(a, b, strict=True):
        if pair not in known:
            known[pair] = None if pair[0] is None or pair[1] is None else jaro_winkler_of(*pair)
        out.append(known[pair])
    return pd.Series(out, dtype="float64")


#: Values whose pairs are all compared beforehand and broadcast.
LISTED = 1000


def with_similarity(df: DataFrame, a: str, b: str, name: str, values: DataFrame | None = None) -> DataFrame:
    """df with the similarity of two columns: made once for each distinct pair that differs, known at once for the others.

    values: one column with all values that these columns have. Where they are few, their pairs are compared and broadcast,
    so that df is neither read twice nor shuffled.
    """
    few = None if values is None else values.toDF(a).dropna().distinct()
    if few is not None and few.limit(LISTED + 1).count() <= LISTED:
        open_ = few.crossJoin(few.toDF(b)).filter(F.col(a) != F.col(b))
        found = F.broadcast(open_.withColumn("__similarity", jaro_winkler(a, b)))
    else:
        open_ = df.filter(F.col(a) != F.col(b)).select(a, b).distinct()
        found = open_.withColumn("__similarity", jaro_winkler(a, b))
    same = F.when(F.col(a) == F.col(b), F.when(F.col(a) == "", 0.0).otherwise(1.0))
    return df.join(found, [a, b], "left").withColumn(name, F.coalesce(same, "__similarity")).drop("__similarity")
