"""Summaries of all batches of a stream, kept up to date by each batch, exactly once.

The summary after batch N is that after batch N - 1 merged with batch N's own part: counts
are added, the latest rows kept. It is written to one of a few places in turn, so that
the one before is whole until the next is, and a batch that is run again starts from it
again. A reader reads as many rows as a summary has, however many batches there were.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardinel.sources.paths import is_present

# A reader that has found the last summary can read it for as long as this many batches
# less one take.
PLACES = 8
THROUGH = "_through"
PLACE = "_place"


class FoldLost(Exception):
    """The summary of the batch before is not where it was kept."""


@dataclass(frozen=True)
class Fold:
    """A summary: the part that a batch adds, and how parts are merged.

    `merge` gets the union of two parts and gives one. `schema` is that of a part.
    """

    schema: T.StructType
    part: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]

    def add(self, rows: DataFrame, folder: str, writer: str, number: int) -> None:
        """Merge the part of a batch in; does nothing if it has been.

        The first batch that is seen may have any number: what was before it is not in
        the summary. From then on no batch may be missing.
        """
        spark, own = rows.sparkSession, f"{folder}/writer={writer}"
        kept = _places(spark, own, self.schema)
        through = _through(kept)
        if number in through:
            return
        part = self.part(rows)
        if number - 1 in through:
            before = kept.filter(F.col(THROUGH).isNull() & (F.col(PLACE) == through[number - 1]))
            part = self.merge(part.unionByName(before.select(*self.schema.names)))
        elif through:
            raise FoldLost(f"{own} has batches {sorted(through)}, not {number - 1}")
        mark = spark.range(1).select(F.lit(number).cast("long").alias(THROUGH))
        whole = part.select(*self.schema.names).unionByName(mark, allowMissingColumns=True)
        # One file, which appears in one step.
        whole.coalesce(1).write.mode("overwrite").parquet(f"{own}/{PLACE}={number % PLACES}")

    def has(self, spark: SparkSession, folder: str, writer: str, number: int) -> bool:
        """Whether a batch that has just been run is in the summary."""
        return number in _through(_places(spark, f"{folder}/writer={writer}", self.schema))

    def read(self, spark: SparkSession, folder: str) -> DataFrame:
        """The summary of all batches of all writers; without batches that of nothing."""
        kept = _places(spark, folder, self.schema)
        if kept is None:
            return self.merge(spark.createDataFrame([], self.schema))
        last = kept.filter(F.col(THROUGH).isNotNull()).groupBy("writer").agg(
            F.max_by(PLACE, THROUGH).alias(PLACE)
        )
        # One row a writer: the filters go into the scan and leave out all other files.
        at = [(F.col("writer") == w) & (F.col(PLACE) == p) for w, p in last.collect()]
        if not at:
            return self.merge(spark.createDataFrame([], self.schema))
        chosen: Column = at[0]
        for place in at[1:]:
            chosen |= place
        rows = kept.filter(chosen & F.col(THROUGH).isNull())
        return self.merge(rows.select(*self.schema.names))

    def step(self, folder: str) -> Callable[[DataFrame, str, int], None]:
        """To follow the batches of a table."""
        return lambda rows, writer, number: self.add(rows, folder, writer, number)


def side_by_side(spark: SparkSession, *tasks: Callable[[], None]) -> None:
    """Run small Spark jobs that do not depend on each other at the same time.

    Waits for all of them; raises the error of the first one that failed.
    """
    with ThreadPoolExecutor(max(1, len(tasks))) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]:
            done.result()


def _through(kept: DataFrame | None) -> dict[int, int]:
    """Places of the last few summaries by the batches that they go through."""
    if kept is None:
        return {}
    return dict(kept.filter(F.col(THROUGH).isNotNull()).select(THROUGH, PLACE).collect())


def _places(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame | None:
    kinds = T.StructType([*schema.fields, T.StructField(THROUGH, T.LongType())])
    kinds = T.StructType([T.StructField(f.name, f.dataType) for f in kinds])
    if "/writer=" not in folder:
        kinds = kinds.add("writer", "string")
    kinds = kinds.add(PLACE, "integer")
    return spark.read.schema(kinds).parquet(folder) if is_present(spark, folder) else None


def sums(keys: Sequence[str], values: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Merge parts by adding up `values` for equal `keys`."""
    return lambda parts: parts.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])


def first_rows(order: Mapping[str, bool], most: int) -> Callable[[DataFrame], DataFrame]:
    """Merge parts by keeping the first rows by columns, ascending or not, without ties."""
    return lambda parts: parts.orderBy(*order, ascending=list(order.values())).limit(most)
