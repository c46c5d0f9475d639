"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardinel.llm import (
    collocations,
    conversations,
    decontamination,
    language,
    lm,
    mixing,
    neardup,
    oracle,
    quality,
    repair,
    rules,
    sharding,
    substrings,
    warc,
)
from cardinel.llm.common import saved, table

SHARDS = 40


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_held_out(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score_held_out(docs, labels)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return rules.judge(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "failed",
    )


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        mixing.word_count(text).alias("size"),
        mixing.text_weight(text).alias("weight"),
    )
    return mixing.mix(saved(rows, "mixing-sizes")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.find(docs.select("doc_id", "text"), items).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.group(table(spark, sf_dir, "documents"), size=3, percent=85).drop("_hash")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_held_out(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), SHARDS)


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn quotes the two before it; the conversations are built back from that."""
    mail = conversations.quoting(table(spark, sf_dir, "conversations"))
    built = conversations.build(mail, ["conv_id"])
    return built.select(
        "message_id", "conv_id", "turn", "role", "thread", "position", "depth", "reply_to", "body"
    )


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audits(repair.damaged(table(spark, sf_dir, "conversations")))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digests(warc.archived(table(spark, sf_dir, "pages"), payloads=False))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_quality_rules": op4_quality_rules,
    "op5_source_mixing": op5_source_mixing,
    "op6_decontamination": op6_decontamination,
    "op7_near_dedup": op7_near_dedup,
    "op8_language_id": op8_language_id,
    "op9_sharding": op9_sharding,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_structure_repair": op11_structure_repair,
    "op12_warc": op12_warc,
    "op13_phrase_mining": op13_phrase_mining,
}

ORACLE_SQL = oracle.QUERIES
