"""A corpus from raw documents to shards, in stages that are written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardinel.llm import decontamination, language, mixing, neardup, sharding
from cardinel.llm.common import saved, table

SHARDS = 40

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; those that the operator rejects go.

    Columns stay as they are, also where the operator adds some of their names.
    """
    names = [c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)]
    found = language.identify(docs.toDF(*names), language.fit(docs)).filter("not rejected")
    return found.select(*[F.col(own).alias(c) for own, c in zip(names, docs.columns, strict=True)])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.dedupe(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard."""
    return sharding.with_shards(docs, SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("source_mixing", mixed_sources),
    ("sharding", in_shards),
]

# Language identification learns from the rows, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
