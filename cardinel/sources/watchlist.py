"""Watchlist entries from a folder of JSON files, one document per line.

Lines are read as text and parsed once, as a map or an array of maps of texts, from
which the schema's fields are cast. Whatever the schema cannot hold is kept in
`_rescued_data`: unknown fields, values of another type, and lines that are no JSON.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardinel.schemas import WATCHLIST
from cardinel.sources.paths import read_if_present


def stream_json_lines(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """Lines of new files, each file once; `maxFilesPerTrigger` bounds a batch."""
    return _lines(spark.readStream.options(**options).text(folder))


def read_json_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark.read.text(folder))


def parse_watchlist(
    lines: DataFrame, schema: T.StructType = WATCHLIST, now: Column | None = None
) -> DataFrame:
    """Fields by schema, the rest as JSON text, the file and time of ingestion.

    A line is one entry or an array of entries. A line that cannot be parsed (broken, cut
    off, neither object nor array) is one entry without fields, whose text is kept whole.
    """
    entry = T.MapType(T.StringType(), T.StringType())
    # An entry on its own becomes an array of one; a broken line gives NULL.
    array = F.when(F.col("value").rlike(r"^\s*\["), F.col("value")).otherwise(
        F.concat(F.lit("["), F.col("value"), F.lit("]"))
    )
    parsed = lines.select(
        "value",
        "file_path",
        F.explode_outer(F.from_json(array, T.ArrayType(entry))).alias("raw"),
    )
    fields = [_field(f.name, f.dataType) for f in schema]
    return parsed.select(
        *fields,
        F.when(F.col("raw").isNull(), F.col("value"))
        .otherwise(_rescued(schema))
        .alias("_rescued_data"),
        "file_path",
        (F.current_timestamp() if now is None else now).alias("ingestion_ts"),
    )


def _field(name: str, kind: T.DataType) -> Column:
    """A field's text as its type: NULL if it has another."""
    text = F.col("raw")[name]
    if kind == T.StringType():
        return text.alias(name)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(text, kind).alias(name)
    return text.try_cast(kind).alias(name)


def infer_schema(spark: SparkSession, folder: str, location: str) -> T.StructType:
    """The schema kept at `location`; on first use inferred from all files there are.

    Every later run gets the first run's types, so a stream does not change its
    columns because of new files; unknown fields go to `_rescued_data`.
    """
    kept = read_if_present(lambda: spark.read.text(location, wholetext=True))
    if kept is not None:
        return T.StructType.fromJson(json.loads(kept.first()[0]))
    schema = spark.read.json(folder).schema
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(location)
    return schema


def _lines(text: DataFrame) -> DataFrame:
    """Non-blank lines with the file they come from."""
    return text.select(
        "value", F.col("_metadata.file_path").alias("file_path")
    ).filter(F.trim("value") != "")


def _rescued(schema: T.StructType) -> Column:
    """Unknown fields, and fields whose value does not have the schema's type."""
    mistyped = [
        (name, _field(name, kind).isNull())
        for name, kind in ((f.name, f.dataType) for f in schema)
        if kind != T.StringType()
    ]

    def keep(name: Column, value: Column) -> Column:
        kept = ~name.isin(*schema.names)
        for field, is_null in mistyped:
            kept |= (name == field) & is_null & value.isNotNull()
        return kept

    rest = F.map_filter("raw", keep)
    return F.when(F.size(rest) > 0, F.to_json(rest))
