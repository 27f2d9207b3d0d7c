"""Quality rules: one threshold table compiled into one Spark projection, without user functions.

Null or empty text has no words and fails the base rules. Ties, repeated rows and extra columns do not matter: each
row is judged on its own text and gives one row. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import SPACES, text_or_empty, words_of

SYMBOLS = "#*$%&|<>"
#: Common function words of the four languages.
STOP_WORDS = (
    "the of and to in a is that it for was with as on be this are he from by at "
    "de la le et les des un une que en du pour dans qui au pas sur par est avec "
    "der die und zu den das von mit sich dem nicht ein eine als auch auf ist für im es "
    "el los y las por con del se lo su para al una como más o no"
).split()
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """metric must lie within [least, most]; None leaves that side open."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None


#: Metrics are SQL over the feature columns of `features`.
RULES = (
    Rule("mean_word_length", "word_chars / n_words", 2.0, 16.0),
    Rule("symbols_per_word", "n_symbols / n_words", None, 0.10),
    Rule("exclamations_per_word", "n_exclamations / n_words", None, 0.20),
    Rule("distinct_stop_words", "n_stop_words", 2, None),
    Rule("duplicate_lines", "n_dup_lines / n_lines", None, 0.50),
    Rule("bullet_lines", "n_bullet_lines / n_lines", None, 0.90),
    Rule("ellipsis_lines", "n_ellipsis_lines / n_lines", None, 0.30),
    Rule("repeated_words", "n_repeat_words / n_words", None, 0.50),
)


#: A window's sort key holds its place in the low bits and its hash in the rest.
PLACE_BITS = 20
COVERED = "cast(aggregate({starts}, named_struct('last', -3L, 'n', 0L), (a, p) -> named_struct('last', p, 'n', a.n + least(3L, p - a.last)), a -> a.n) AS bigint)"


def _window_keys(words: str) -> Column:
    """Sorted keys (hash, place) of a text's 3-word windows, as plain longs."""
    key = f"shiftleft(xxhash64({words}[i], {words}[i + 1], {words}[i + 2]), {PLACE_BITS}) | cast(i AS bigint)"
    return F.expr(f"CASE WHEN size({words}) < 3 THEN cast(array() AS array<bigint>) ELSE sort_array(transform(sequence(0, size({words}) - 3), i -> {key})) END")


def _inexact(words: str, keys: str) -> Column:
    """Whether equal hashes hide different windows, or the places outgrow their bits."""
    place = f"cast({{}} & {(1 << PLACE_BITS) - 1}L AS int)"
    x, y = place.format("x"), place.format(f"{keys}[j - 1]")
    differ = " OR ".join(f"{words}[{x} + {k}] != {words}[{y} + {k}]" for k in range(3))
    return F.expr(f"size({words}) > {1 << PLACE_BITS} OR size(filter({keys}, (x, j) -> j > 0 AND shiftright(x, {PLACE_BITS}) = shiftright(get({keys}, j - 1), {PLACE_BITS}) AND ({differ}))) > 0")


def _whole_windows(words: str, wanted: str) -> Column:
    """Where wanted: the windows themselves with their places, sorted; else empty."""
    window = f"named_struct('g', concat_ws(' ', {words}[i], {words}[i + 1], {words}[i + 2]), 'i', cast(i AS bigint))"
    return F.expr(f"CASE WHEN {wanted} THEN sort_array(transform(sequence(0, size({words}) - 3), i -> {window})) ELSE cast(array() AS array<struct<g:string,i:bigint>>) END")


def _starts(keys: str, windows: str, inexact: str) -> Column:
    """Sorted starts of the windows found twice or more; by the hashes, or by the words where those would not be exact."""
    same = f"shiftright(get({keys}, j {{}} 1), {PLACE_BITS}) <=> shiftright(x, {PLACE_BITS})"
    fast = f"transform(filter({keys}, (x, j) -> {same.format('-')} OR {same.format('+')}), x -> x & {(1 << PLACE_BITS) - 1}L)"
    slow = f"transform(filter({windows}, (x, j) -> x.g <=> get({windows}, j - 1).g OR x.g <=> get({windows}, j + 1).g), x -> x.i)"
    return F.expr(f"sort_array(CASE WHEN {inexact} THEN {slow} ELSE {fast} END)")


def features(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep and the feature columns of each row's whole text."""
    df = docs.select(*keep, text_or_empty().alias("__text"))
    df = df.select(
        *keep,
        "__text",
        words_of(F.col("__text")).alias("__words"),
        F.translate("__text", SPACES, "").alias("__dense"),
        F.filter(F.split("__text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("__lines"),
    )
    df = df.select(
        *keep,
        "__words",
        F.size("__words").cast("long").alias("n_words"),
        F.length("__dense").cast("long").alias("word_chars"),
        (F.length("__dense") - F.length(F.translate("__dense", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("__dense") - F.length(F.replace(F.col("__dense"), F.lit("!"), F.lit("")))).cast("long").alias("n_exclamations"),
        F.size(F.array_intersect("__words", F.lit(list(dict.fromkeys(STOP_WORDS))))).cast("long").alias("n_stop_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("__lines", lambda x: F.ltrim(x).rlike("^[-*•·]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("__lines", lambda x: F.rtrim(x).rlike(r"(\.\.\.|…)$"))).cast("long").alias("n_ellipsis_lines"),
        _window_keys("__words").alias("__keys"),
    )
    df = df.withColumn("__inexact", _inexact("__words", "__keys")).withColumn("__windows", _whole_windows("__words", "__inexact"))
    df = df.withColumn("__starts", _starts("__keys", "__windows", "__inexact")).withColumn("n_repeat_words", F.expr(COVERED.format(starts="__starts")))
    return df.drop("__words", "__keys", "__inexact", "__windows", "__starts")


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where every rule holds; meant for rows with at least one word."""
    tests = F.lit(True)
    for rule in rules:
        metric = F.expr(rule.metric)
        if rule.least is not None:
            tests &= metric >= rule.least
        if rule.most is not None:
            tests &= metric <= rule.most
    return tests


def failed_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that a row breaks."""
    broken = []
    for rule in rules:
        metric = F.expr(rule.metric)
        out = F.lit(False)
        if rule.least is not None:
            out |= metric < rule.least
        if rule.most is not None:
            out |= metric > rule.most
        broken.append(F.when(out, F.lit(rule.name)))
    return F.array_compact(F.array(*broken))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Features, base_failed, kept and the names of broken rules for every row."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    df = features(docs, keep).withColumn("base_failed", base)
    broken = F.when(F.col("n_words") == 0, F.array().cast("array<string>")).otherwise(failed_rules(rules))
    return df.withColumn("failed_rules", broken).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
