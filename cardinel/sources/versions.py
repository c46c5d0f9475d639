"""Schemas that follow a feed: a log of versions, and tables that stay readable through all.

A version is added when a batch brings fields that are new or values that the last version's
types cannot hold; none is ever changed. A field that appears becomes a column of the
table from that batch on. A column keeps the type it began with, as files that are written
cannot change; a value that does not fit is kept as text with the rescued data. Reading by
a version puts both together: a field has the version's type in every row, also in those
that were written before the field or the type was known.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardinel.sources.paths import is_present

RESCUED = "_rescued_data"
# What Spark's JSON reader calls a line that it cannot parse.
CORRUPT = "_corrupt_record"


def widened(one: T.DataType, other: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text holds all."""
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    if {type(one), type(other)} == {T.LongType, T.DoubleType}:
        return T.DoubleType()
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        return T.ArrayType(widened(one.elementType, other.elementType))
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        return merged(one, other)
    return T.StringType()


def merged(one: T.StructType, other: T.StructType) -> T.StructType:
    """All fields of both, in the order in which they appeared, each wide enough for both."""
    found = {f.name: f.dataType for f in other}
    fields = [T.StructField(f.name, widened(f.dataType, found.pop(f.name, f.dataType))) for f in one]
    return T.StructType(fields + [T.StructField(name, kind) for name, kind in found.items()])


def inferred(spark: SparkSession, paths: list[str]) -> T.StructType:
    """The fields of JSON line files; those that are never more than null are texts."""
    found = spark.read.json(paths).schema
    return T.StructType([T.StructField(f.name, f.dataType) for f in found if f.name != CORRUPT])


@dataclass(frozen=True)
class SchemaLog:
    """Versions in a folder, one file each: its number, the batch it began with, its fields."""

    spark: SparkSession
    folder: str

    def versions(self) -> list[tuple[int, str, T.StructType]]:
        if not is_present(self.spark, self.folder):
            return []
        rows = self.spark.read.schema("since string, fields string, version int").json(self.folder)
        kept = rows.select("version", "since", "fields").orderBy("version").collect()
        return [(r.version, r.since, T.StructType.fromJson(json.loads(r.fields))) for r in kept]

    def latest(self) -> T.StructType:
        versions = self.versions()
        return versions[-1][2] if versions else T.StructType()

    def follow(self, found: T.StructType, since: str) -> T.StructType:
        """The latest version, after adding one if it cannot hold what was found.

        A batch that is run again finds the version that it added, and adds none.
        """
        versions = self.versions()
        last = versions[-1][2] if versions else T.StructType()
        wider = merged(last, found)
        if versions and wider == last:
            return last
        number = len(versions)
        row = self.spark.range(1).select(
            F.lit(since).alias("since"), F.lit(wider.json()).alias("fields")
        )
        row.coalesce(1).write.mode("overwrite").json(f"{self.folder}/version={number}")
        return wider


def add_columns(spark: SparkSession, table: str, fields: T.StructType) -> T.StructType:
    """Add the fields that a table lacks; returns its columns of those names as they are.

    Names are compared as the catalog does, without regard to case.
    """
    have = {f.name.lower(): f for f in spark.read.table(table).schema}
    missing = [f for f in fields if f.name.lower() not in have and not isinstance(f.dataType, T.NullType)]
    if missing:
        names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({names})")
        have |= {f.name.lower(): f for f in missing}
    kept = (have.get(f.name.lower()) for f in fields)
    return T.StructType([T.StructField(f.name, f.dataType) for f in kept if f is not None])


def by_version(rows: DataFrame, fields: T.StructType) -> DataFrame:
    """Rows with the fields of a version in its types, wherever their values are kept.

    A value is taken from its column, or else from the rescued data, which keeps fields
    and values that came before their column or did not fit it.
    """
    stored = {f.name.lower(): f for f in rows.schema}
    rescued = F.from_json(RESCUED, T.MapType(T.StringType(), T.StringType()))
    columns = []
    for field in fields:
        text = F.element_at(rescued, field.name)
        value = _as(text, field.dataType)
        own = stored.get(field.name.lower())
        if own is not None:
            value = F.coalesce(_changed(F.col(f"`{own.name}`"), own.dataType, field.dataType), value)
        columns.append(value.alias(field.name))
    names = {f.name.lower() for f in fields}
    rest = [F.col(f"`{f.name}`") for f in rows.schema if f.name.lower() not in names]
    return rows.select(*columns, *rest)


def _nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.ArrayType, T.MapType))


def _as(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.NullType)):
        return text
    return F.from_json(text, kind) if _nested(kind) else text.try_cast(kind)


def _changed(value: Column, own: T.DataType, kind: T.DataType) -> Column:
    if own == kind:
        return value
    if _nested(own):
        return _as(F.to_json(value), kind)
    return value.try_cast(kind) if not _nested(kind) else F.lit(None).cast(kind)
