"""Salting, for joins that get no adaptive split of hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_over_salts(
    df: DataFrame, key: str, by: Sequence[str], salts: int, hot: Sequence[str] | None = None
) -> DataFrame:
    """Give each row of a hot key a `salt` from the columns `by`; 0 to the others.

    Without a list all keys are hot. A retried task gives the same salt again, which
    a random number would not.
    """
    salt = F.pmod(F.xxhash64(*[F.col(name) for name in by]), F.lit(salts)).cast("int")
    return df.withColumn("salt", salt if hot is None else F.when(_is(key, hot), salt).otherwise(0))


def copy_to_salts(
    df: DataFrame, key: str, salts: int, hot: Sequence[str] | None = None
) -> DataFrame:
    """Give each row of a hot key once per `salt`, the others once with salt 0."""
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    if hot is not None:
        every = F.when(_is(key, hot), every).otherwise(F.array(F.lit(0)))
    return df.withColumn("salt", F.explode(every))


def hot_keys(df: DataFrame, key: str, parts: int) -> list[str]:
    """Keys with more than one `parts`-th of all rows, of which there are fewer than `parts`."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    share = df.agg(F.count(F.lit(1)) / parts).scalar()
    found = counts.filter((F.col("n") > share) & F.col(key).isNotNull())
    return sorted(row[key] for row in found.collect())


def _is(key: str, hot: Sequence[str]) -> Column:
    return F.coalesce(F.col(key).isin(*hot), F.lit(False)) if hot else F.lit(False)
