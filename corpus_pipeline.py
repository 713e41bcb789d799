"""A pipeline over documents: toxic documents go, one of each group of near copies stays, repeated
passages go, sources are mixed to their target weights, and the result is tokenised.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's result
as Parquet in the shared folder and reads it again for the next one. All stages but the last keep
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from maskwright.llm import bpe, jaccard, mixing, suffixes, toxicity
from maskwright.llm.common import cut, table, tune
from maskwright.llm.queries import BPE_RANKS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return toxicity.filter_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return jaccard.keep_first(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return suffixes.remove_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tune(spark)
    return bpe.encode_decode(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", one_of_each),
    ("suffix_dedup", drop_repeats),
    ("mixing", mix),
    ("byte_bpe", tokenise),
]
#: SQL can't express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
