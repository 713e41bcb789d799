"""Thin queries: each applies an operator to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.llm import bpe, chat, jaccard, licenses, mixing, neardup, quality, spotsigs, suffixes, toxicity
from maskwright.llm.common import table, tune

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return jaccard.similarity_classes(table(spark, sf_dir, "documents"))


def op2_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return suffixes.repeat_digests(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tune(spark)
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    probe = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digest_conversations(chat.format_records(chat.mixed_records(rows)))


def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_edited(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
