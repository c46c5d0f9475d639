"""Incremental export of watchlist entries to the folder the stream reads.

The highest number among the landed ids is the mark: an export adds the entries
above it. With nothing landed, all entries are new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardinel.functions import watchlist_number
from cardinel.schemas import WATCHLIST
from cardinel.sources.paths import read_if_present


def read_watchlist_csv(spark: SparkSession, path: str) -> DataFrame:
    """Entries from CSV files with a header, every column as text."""
    return spark.read.csv(path, header=True)


def read_landed(spark: SparkSession, folder: str) -> DataFrame:
    """Ids landed so far; none if the folder does not exist yet."""
    ids = WATCHLIST["watchlist_id"]
    schema = f"{ids.name} {ids.dataType.simpleString()}"
    landed = read_if_present(lambda: spark.read.schema(schema).json(folder))
    return spark.createDataFrame([], schema) if landed is None else landed


def landed_mark(landed: DataFrame) -> DataFrame:
    """Highest landed number as one row: NULL, if no id has one above zero."""
    number = watchlist_number("watchlist_id")
    return landed.agg(F.max(F.when(number > 0, number)).alias("mark"))


def new_entries(source: DataFrame, landed: DataFrame) -> DataFrame:
    """Source entries above the mark, as a filter by an uncorrelated subquery.

    An id without a number cannot be placed above a mark, so such an entry is
    exported only while nothing has landed.
    """
    mark = landed_mark(landed).scalar()
    number = watchlist_number("watchlist_id")
    return source.filter(mark.isNull() | (number > mark)).withColumn(
        "entity_id", F.col("entity_id").cast("string")
    )


def export_entries(spark: SparkSession, csv: str, folder: str) -> None:
    """Land the entries of CSV files that are above the mark, as lines of JSON.

    What an export writes becomes visible as a whole, so one that failed can be repeated.
    """
    new = new_entries(read_watchlist_csv(spark, csv), read_landed(spark, folder))
    new.write.mode("append").json(folder)
