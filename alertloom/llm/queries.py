"""One query for each operator of this folder, over whole tables, and what SQL can say of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertloom.llm import (
    collocations,
    conversations,
    decontamination,
    line_dedup,
    mixing,
    piece_coding,
    quality_rules,
    secret_scan,
    sharding,
    simhash_dedup,
    substring_dedup,
    token_counts,
    toxicity,
)
from alertloom.llm.oracle import ORACLE as ORACLE


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeats(documents(spark, folder))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.section_tokens(documents(spark, folder))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(documents(spark, folder)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op4_piece_coding(spark: SparkSession, folder: str) -> DataFrame:
    return piece_coding.digests(documents(spark, folder))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(documents(spark, folder))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's text without repeated lines, as a digest, and how many lines went."""
    docs = documents(spark, folder)
    lines = lambda text: F.size(F.split(F.coalesce(text, F.lit("")), "\n", -1)).cast("long")
    kept = line_dedup.dedup_lines(docs.withColumn("n_lines", lines(F.col("text"))), distance=None)
    return kept.select(
        "doc_id",
        "n_lines",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"),
    )


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(documents(spark, folder), table(spark, folder, "labels"))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(documents(spark, folder))


def op9_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_dedup.near_groups(documents(spark, folder))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(documents(spark, folder), table(spark, folder, "benchmark"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair_damaged(table(spark, folder, "conversations"))


def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(documents(spark, folder))


def op13_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_token_counts,
        op3_quality_rules,
        op4_piece_coding,
        op5_secret_scan,
        op6_line_dedup,
        op7_toxicity,
        op8_sharding,
        op9_simhash_dedup,
        op10_decontamination,
        op11_conversation_repair,
        op12_phrase_collocations,
        op13_source_mixing,
    )
}
