"""The registered queries op1 .. op13 over the whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from placeflow.llm import (bpe, chat, collocations, decontam, line_dedup, quality_rules, quality_zstd, simhash, spelling,
                           substring_dedup, token_counts, toxicity, vector_topk)
from placeflow.llm.common import table
from pyspark.sql import functions as F

CHECK_TEXT = "</s>[INST] ok [/INST]"  # both turns of conversation -1


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op2_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_zstd.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), radius=None).drop("other")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(CHECK_TEXT).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(check)
    return chat.read_back(chat.segments(rows)).withColumn("bad_turn", F.coalesce("bad_turn", F.lit(-1)))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, overlap=80, most=2000)


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), factor=10, shortest=7, every=31, least=2)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_bpe_round_trip, op2_simhash_groups, op3_quality_classifier, op4_quality_rules,
                            op5_line_dedup, op6_substring_dedup, op7_token_counts, op8_toxicity, op9_chat_format,
                            op10_decontamination, op11_phrase_collocations, op12_exact_topk, op13_spelling_variants)}
