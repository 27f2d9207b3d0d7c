"""The training-data queries over the driver's tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evidentia.llm import fingerprints, langid, linededup, lm, packing, pii, quality, sentencepiece_fst, simhash, token_output
from evidentia.llm.common import documents, fold_column, scratch_path, tokenizer_path


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every whole text: their number, those of byte fallback, a crc32 of the ids, and whether they decode to the text."""
    return sentencepiece_fst.digest(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measures and its verdicts; a null text has no words."""
    judged = quality.judge(documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 1024; a null text is its end id alone."""
    return packing.pack(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text with pseudonyms, and how many of which kinds; a null text stays null."""
    made = pii.pseudonymise(documents(spark, sf_dir).select("doc_id", "text"))
    return made.withColumnsRenamed({"__n": "n_replaced", "__kinds": "kinds"})


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's fingerprint and its likeness to the edited and to the next text; a null text is empty."""
    return fingerprints.fingerprint(documents(spark, sf_dir))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's fingerprint and the smallest doc_id that links of two bits reach."""
    return simhash.near_duplicates(documents(spark, sf_dir)).select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from the files just written: where its ids start, their number and crc32."""
    folder = scratch_path(spark, "token-files")
    token_output.write(documents(spark, sf_dir), folder, tokenizer_path("byte_bpe_50k.json"))
    return token_output.read(spark, folder)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's predicted language, from models of the documents that are not held out."""
    docs = documents(spark, sf_dir)
    held_out = fold_column("doc_id", 4) == 2
    models = langid.fit(docs.filter(~held_out))
    return langid.predict(docs, models).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the lines that resemble an earlier one, and how many it had and lost."""
    cleaned = linededup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return cleaned.withColumnsRenamed({"__n_lines": "n_lines", "__n_removed": "n_removed"})


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's base score and model score, from the documents that are not held out."""
    return lm.score(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quality_rules": op2_quality_rules,
    "op3_packing": op3_packing,
    "op4_pii": op4_pii,
    "op5_fingerprints": op5_fingerprints,
    "op6_simhash": op6_simhash,
    "op7_token_output": op7_token_output,
    "op8_language_id": op8_language_id,
    "op9_line_dedup": op9_line_dedup,
    "op10_lm_scoring": op10_lm_scoring,
}
_WORD = r"[^\x20\x09-\x0D]"
_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.STOP_WORDS))
_LIMITS = " AND ".join(f"{r.metric} {sign} {bound}" for r in quality.RULES for sign, bound in ((">=", r.least), ("<=", r.most)) if bound is not None)

_QUALITY_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (SELECT doc_id, regexp_extract_all(t, '{_WORD}+') AS ws FROM d)),
g AS (SELECT doc_id, i, w, lead(w) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w1, w2) AS n FROM g WHERE w2 IS NOT NULL) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(3) r(k) GROUP BY doc_id),
words AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars, sum(length(w) - length(regexp_replace(w, '[#*$%&|<>]', '', 'g'))) AS n_symbols,
 sum(length(w) - length(replace(w, '!', ''))) AS n_exclamations, count(DISTINCT w) FILTER (WHERE w IN ({_STOP})) AS n_stop_words FROM w GROUP BY doc_id),
l AS (SELECT doc_id, l FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '{_WORD}')),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines, count(*) FILTER (WHERE regexp_matches(ltrim(l, ' '), '^[-*•·]')) AS n_bullet_lines,
 count(*) FILTER (WHERE regexp_matches(rtrim(l, ' '), '(\.\.\.|…)$')) AS n_ellipsis_lines FROM l GROUP BY doc_id),
f AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, coalesce(n_symbols, 0) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
 n_exclamations, n_stop_words, n_lines, n_bullet_lines, n_ellipsis_lines FROM d LEFT JOIN words USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
 base_failed, NOT base_failed AND coalesce({_LIMITS}, false) AS kept FROM b"""

#: Prefixes by exact rarity here, by hash buckets in the operator.
_LINES_SQL = rf"""
WITH p AS (SELECT doc_id, i, l, regexp_matches(l, '{_WORD}') AS has_word FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)),
x AS (SELECT doc_id, i, list_sort(list_distinct(regexp_extract_all(l, '{_WORD}+'))) AS ws FROM p WHERE has_word),
s AS (SELECT ws, len(ws) AS n, min(struct_pack(d := doc_id, i := i)) AS f, row_number() OVER () AS k FROM x GROUP BY ws),
t AS (SELECT k, n, f, unnest(ws) AS w FROM s),
c AS (SELECT w, count(*) AS c FROM t GROUP BY w),
r AS (SELECT k, n, f, w, row_number() OVER (PARTITION BY k ORDER BY c, w) AS r FROM t JOIN c USING (w)),
z AS (SELECT k, n, f, w FROM r WHERE r <= n - (4 * n + 4) // 5 + 1),
pairs AS (SELECT DISTINCT a.k AS a, b.k AS b FROM z a JOIN z b ON a.w = b.w AND a.f > b.f AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
near AS (SELECT DISTINCT a FROM (SELECT a, u.n AS un, v.n AS vn, len(list_intersect(u.ws, v.ws)) AS o FROM pairs JOIN s u ON u.k = a JOIN s v ON v.k = b) WHERE 5 * o >= 4 * (un + vn - o)),
gone AS (SELECT x.doc_id, x.i FROM x JOIN s ON x.ws = s.ws LEFT JOIN near ON near.a = s.k WHERE near.a IS NOT NULL OR s.f <> struct_pack(d := x.doc_id, i := x.i)),
out AS (SELECT p.doc_id, string_agg(l, chr(10) ORDER BY p.i) FILTER (WHERE gone.i IS NULL) AS text, count(*) FILTER (WHERE has_word) AS n_lines, count(gone.i) AS n_removed FROM p LEFT JOIN gone ON p.doc_id = gone.doc_id AND p.i = gone.i GROUP BY p.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(o.text, '') END AS text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed FROM documents d LEFT JOIN out o USING (doc_id)"""

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": _QUALITY_SQL,
    "op9_line_dedup": _LINES_SQL,
}
