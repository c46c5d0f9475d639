"""Layers, declared tables and the guard against resetting them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

# The layers, and the properties a table carries.
LAYERS = ("bronze", "silver", "gold", "etl", "source")
QUALITY = "quality"
RESET_ALLOWED = "pipelines.reset.allowed"


class ResetRefused(Exception):
    """The table is protected against a reset."""


def create_layers(
    spark: SparkSession, layers: Iterable[str] = LAYERS, folder: str | None = None
) -> None:
    """Create the layers' databases if missing, each in its own subfolder if given."""
    for layer in layers:
        where = f" LOCATION '{folder}/{layer}'" if folder else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{where}")


def declare(
    spark: SparkSession,
    table: str,
    schema: StructType,
    comment: str,
    quality: str,
    protected: bool = False,
    extra: Mapping[str, str] | None = None,
    table_format: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Create the table if missing, so that readers can be planned before it has rows."""
    if spark.catalog.tableExists(table):
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    text = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING {table_format}{parts} COMMENT '{text}'")
    values = {QUALITY: quality, RESET_ALLOWED: str(not protected).lower(), **(extra or {})}
    pairs = ", ".join(f"'{key}' = '{value}'" for key, value in values.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def reset(spark: SparkSession, table: str) -> None:
    """Drop a table, unless it is protected or a query is writing to it.

    Give the next run another checkpoint: it then reads its source from the start.
    """
    if any(query.name == table for query in spark.streams.active):
        raise ResetRefused(f"{table} has a running query")
    if table_properties(spark, table).get(RESET_ALLOWED) == "false":
        raise ResetRefused(f"{table} has {RESET_ALLOWED} = false")
    spark.sql(f"DROP TABLE {table}")
