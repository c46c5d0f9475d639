"""What several operators need: tables, intermediate results, words, ranks within groups."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardinel.session import settings, work_folder

# Shuffle files of a query are deleted when it ends, not when the driver collects garbage.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Python workers find this package where the driver found it."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared work folder and read it back.

    Cuts the lineage: what was computed once is not computed again, and a lost
    executor costs at most the tasks it was running. The shuffle files it took are
    given up at once.
    """
    folder = work_folder(df.sparkSession, name)
    with settings(df.sparkSession, SHUFFLES_GO):
        df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def all_columns(docs: DataFrame, *without: str) -> Column:
    """A caller's columns as one struct `_all`, so that no name of theirs meets one of ours.

    `_all.*` gives them back.
    """
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in without]).alias("_all")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def word_list(text: Column) -> Column:
    """The words between ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once for a row, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def crc(doc_id: Column, parts: int) -> Column:
    """The fold of a document: crc32 of its id as text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def row_key(*columns: Column) -> Column:
    """A struct that joins with its equal even where fields are null."""
    return F.struct(*columns)


def prefix_sums(
    df: DataFrame, group: list[str], bucket: str, order: list[Column], value: str, name: str
) -> DataFrame:
    """Sum of `value` over the rows before each row, within its group and order.

    `bucket` must rise with the order. Sums of whole buckets are added up first, so
    that no task sorts more than one bucket of a group, however large the group is.
    """
    keys = [F.col(c) for c in group]
    sums = df.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy(bucket)
    sums = sums.select(
        row_key(*keys, F.col(bucket)).alias("_key"),
        (F.sum("_sum").over(before) - F.col("_sum")).alias("_prior"),
    )
    inside = Window.partitionBy("_key").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        df.withColumn("_key", row_key(*keys, F.col(bucket)))
        .join(sums, "_key")
        .withColumn(name, F.col("_prior") + F.sum(value).over(inside) - F.col(value))
        .drop("_key", "_prior")
    )
