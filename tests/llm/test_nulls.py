"""Nulls in any column, repeated rows, ties and extra columns: no operator crashes or loses rows."""

import pytest

from maskwright.llm import bpe, jaccard, licenses, mixing, neardup, quality, queries, spotsigs, suffixes, toxicity



def encode(docs):
    tokenizers = pytest.importorskip("public_tokenizers")
    return bpe.encode_decode(docs, tokenizers.path(queries.BPE_RANKS), tokenizers.PATTERN)


ROWS = [(None, None, None, None, None, 1), (None, "some text of it", None, "s", 3, 1), (None, "some text of it", None, "s", 3, 1), (4, None, "en", "s", 0, 1), (4, "x " * 400, "en", None, 800, 1), (4, "x " * 400, "en", None, 800, 1), (5, "y " * 300, "de", "s", 600, 1), (6, "", "de", "s", 0, 1)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize(
    "run",
    [
        jaccard.similarity_classes,
        suffixes.repeat_digests,
        mixing.mix_plan,
        encode,
        spotsigs.compare_edited,
        licenses.scan,
        suffixes.remove_repeats,
    ],
)
def test_every_row_has_a_result(docs, run):
    assert run(docs).count() == len(ROWS)
    assert run(docs.limit(0)).count() == 0


def test_models_with_nulls(spark, docs):
    labels = spark.createDataFrame([(None, 1), (4, None), (5, 0), (6, 1), (6, 1)], "doc_id long, toxic int")
    assert toxicity.score_documents(docs, labels).count() == len(ROWS)
    assert toxicity.filter_toxic(docs, labels).columns == docs.columns
    assert toxicity.score_documents(docs.limit(0), labels.limit(0)).count() == 0


def test_quality_with_nulls_and_clashing_names(spark, docs):
    labels = spark.createDataFrame([(None, 1), (4, None), (5, 0), (6, 1), (6, 1)], "doc_id long, quality int")
    clash = docs.selectExpr("*", "1 AS score", "'x' AS held_out", "2 AS predicted", "3 AS y", "4 AS r").drop("lang")
    got = quality.score_documents(clash, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    assert quality.score_documents(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in quality.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    toxic = toxicity.filter_toxic(clash, labels.withColumnRenamed("quality", "toxic"))
    assert toxic.columns == clash.columns and toxic.count() <= len(ROWS)


def test_keep_first_keeps_rows_without_id(docs):
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    assert sum(r["doc_id"] is None for r in kept.collect()) == 3


def test_vectors_with_null_ids(spark):
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None)]
    assert neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).count() == 4
