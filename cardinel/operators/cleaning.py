"""Raw messages and records to typed, normalised columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardinel.functions import parse_effective_from, parse_open_date
from cardinel.schemas import CUSTOMER, TRANSACTION, WATCHLIST


def parse_transactions(bronze: DataFrame, now: Column | None = None) -> DataFrame:
    """Message text to the transaction's fields, with its place in the topic.

    Text that is no JSON gives NULL fields, which the quality rules then drop.
    """
    return bronze.select(
        F.from_json("value", TRANSACTION).alias("data"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("ingestion_ts").alias("bronze_ingestion_timestamp"),
    ).select(
        "data.*",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "bronze_ingestion_timestamp",
        _now(now).alias("silver_ingestion_timestamp"),
    )


def clean_watchlist(bronze: DataFrame, now: Column | None = None) -> DataFrame:
    """Codes in upper case and the effective time parsed; bad times are NULL."""
    changed = {
        "watchlist_id": F.upper("watchlist_id"),
        "entity_id": F.upper("entity_id"),
        "action": F.upper("action"),
        "risk_level": F.upper("risk_level"),
        "effective_from": parse_effective_from("effective_from"),
    }
    return bronze.select(
        *_with(WATCHLIST.names, changed),
        "_rescued_data",
        F.col("file_path").alias("source_file"),
        F.col("ingestion_ts").alias("bronze_ingestion_timestamp"),
        _now(now).alias("silver_ingestion_timestamp"),
    )


def clean_customers(bronze: DataFrame, now: Column | None = None) -> DataFrame:
    """The customer columns with the opening date parsed; bad dates are NULL."""
    changed = {"account_open_date": parse_open_date("account_open_date")}
    return bronze.select(
        *_with(CUSTOMER.names, changed),
        _now(now).alias("silver_ingestion_timestamp"),
    )


def _with(names: list[str], changed: dict[str, Column]) -> list[Column]:
    return [changed.get(name, F.col(name)).alias(name) for name in names]


def _now(now: Column | None) -> Column:
    return F.current_timestamp() if now is None else now
