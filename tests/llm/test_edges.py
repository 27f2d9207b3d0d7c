"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from evidentia.llm import fingerprints, langid, linededup, lm, packing, pii, quality, sentencepiece_fst, simhash, token_output
from evidentia.llm.common import scratch_path, tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `count` long, h string, d int, row string, fp long, `a.b` int, __row string, __text string, gone int, shard int, __parts int"
LONG = "alpha beta gamma " * 30_000
BPE = tokenizer_path("byte_bpe_50k.json")


def rows():
    texts = [None, "", " \n\t ", "a", "The cat sat on the mat and that was all of it.", "The cat sat on the mat and that was all of it.", "x" * 40_000, LONG, "é日本🙂\r\nb", "\n\n\n"]
    more = ("x", "y", 3, 4, 5)
    out = [(k, t, "en" if k % 2 else None, None, None, 1, "q", 2, "r", 7, 1, *more) for k, t in enumerate(texts)]
    return [*out, out[4], (4, "another text", "fr", "s", 3, *[None] * 11), (None, "no id", None, None, None, 1, "q", 2, "r", 7, 1, *more)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def written(docs):
    folder = scratch_path(docs.sparkSession, "files")
    token_output.write(docs, folder, BPE)
    return token_output.read(docs.sparkSession, folder)


OPERATORS = {
    "sentencepiece": lambda d: sentencepiece_fst.digest(d, tokenizer_path("piece_bpe_32k.model")),
    "quality": quality.judge,
    "pii": pii.pseudonymise,
    "fingerprints": fingerprints.fingerprint,
    "simhash": simhash.near_duplicates,
    "token_output": written,
    "langid": lambda d: langid.predict(d, langid.fit(d)),
    "linededup": linededup.dedup_lines,
    "lm": lm.score,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_every_row(docs, none, name):
    got = OPERATORS[name](docs)
    assert sorted(map(str, (r.doc_id for r in got.collect()))) == sorted(str(r[0]) for r in rows())
    assert OPERATORS[name](none).count() == 0


def test_packing_covers_every_id(docs, none):
    got = packing.pack(docs, BPE).toPandas()
    assert got.length.sum() == sum(r.n_tokens for r in written(docs).collect())
    ends = (got.sort_values("offset").groupby("sequence_id").length.cumsum()).groupby(got.sequence_id).max()
    assert (ends == got.groupby("sequence_id").length.sum()).all() and ends.max() <= packing.CAPACITY
    assert packing.pack(none, BPE).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_the_columns(spark, docs, none, name, stage):
    got = stage(spark, docs, "")
    assert got.columns == docs.columns and [t for _, t in got.dtypes] == [t for _, t in docs.dtypes]
    assert 0 < got.count() <= len(rows())
    assert stage(spark, none, "").count() == 0


def test_stages_decide(spark, docs):
    ids = lambda df: sorted(str(r.doc_id) for r in df.collect())
    assert not {"0", "1", "2", "9"} & set(ids(corpus_pipeline.language_id(spark, docs, "")))
    one = corpus_pipeline.simhash_dedup(spark, docs, "")
    assert ids(one).count("0") == 1 and not {"1", "2", "5", "9"} & set(ids(one)) and one.filter("doc_id = 4").count() == 2
    lines = {r.text for r in corpus_pipeline.line_dedup(spark, docs, "").filter("doc_id = 5").collect()}
    assert lines == {""}
    assert corpus_pipeline.pseudonyms(spark, docs.withColumn("text", F.lit("call +1 (415) 555-2671")), "").filter("text LIKE '%2671%'").count() == 0
