"""Corpus pipeline: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next
stage's docs. All but the last return the columns of documents; n_chars follows the text where a stage rewrites it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.llm import langid, linededup, nearcopies, packing, pii, simhash
from evidentia.llm.common import fold_column, scratch_table, tokenizer_path


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars, where there is one, of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go: those without a letter, and those that no learned language explains."""
    models = langid.fit(docs.filter(fold_column("doc_id", 4) != 2))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row")
    return langid.predict(docs, models, [row]).filter("accepted").select("__row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that resemble an earlier one go; a document stays even if no line is left."""
    return _recounted(linededup.dedup_lines(docs).drop("__n_lines", "__n_removed"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group that links make: SimHash fingerprints within two bits of each other, found by BK-trees
    (as op6), and near copies which differ in more bits, by an exact join (Jaccard 0.8 or more of five-word shingles)."""
    found = scratch_table(nearcopies.near_copies(docs), "near-copies")
    return simhash.first_rows(docs, nearcopies.merged(found, simhash.near_duplicates(docs)))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses become pseudonyms."""
    return _recounted(pii.pseudonymise(docs).drop("__n", "__kinds"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("pii", pseudonyms),
    ("packing", pack),
]

#: The stages learn models, walk trees and tokenise, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
