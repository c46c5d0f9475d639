"""Micro-batches that are transformed with tables as they stand when the batch runs.

A stream joined with a table keeps the table's files of the time it was planned. Here
each batch reads its tables anew. The result goes to the batch's own partition of the
target, which is there as a whole or not at all. A batch that is run again after a failure
finds its partition and leaves it alone: who reads the target sees no row twice, and
what was said first holds, whatever has become of the tables that were joined.

Rule counts of a batch come from the pass that writes its rows, and are added to the
counts of all batches before the batch is done. A batch that is run again because it died
between the two counts its rows anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cardinel.operators.quality import Expectation, all_counts, counts_by_rule, meet
from cardinel.session import settings
from cardinel.sources.paths import is_present, read_if_present
from cardinel.streaming.folds import Fold, side_by_side, sums
from cardinel.streaming.runner import CATCH_UP

# An insert replaces the partitions it has rows for, and no others.
OWN_PARTITION = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}

# The column of a target that says which batch of which checkpoint wrote a row.
BATCH = "batch"

# What follows a batch: gets the rows it wrote, its writer and its number.
Step = Callable[[DataFrame, str, int], None]

COUNTS = Fold(
    T.StructType().add("metric", "string").add("rule", "string").add("n", "long"),
    lambda counts: counts,
    sums(["metric", "rule"], ["n"]),
)


def writer_id(spark: SparkSession, checkpoint: str) -> str:
    """A name for the checkpoint, kept in it: another checkpoint has another name."""
    place = f"{checkpoint.rstrip('/')}/writer-id"
    kept = read_if_present(lambda: spark.read.text(place))
    if kept is not None:
        return kept.first()[0]
    name = uuid.uuid4().hex
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.text(place)
    return name


def rows_of_batches(spark: SparkSession, table: str, keys: Sequence[str]) -> DataFrame:
    """The rows of a table that some batches wrote, as they stand."""
    spark.catalog.refreshTable(table)
    return spark.read.table(table).filter(F.col(BATCH).isin(*keys))


def is_written(spark: SparkSession, table: str, key: str) -> bool:
    """Whether a batch has its partition: its folder, which appears in one step."""
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    place = detail.first().data_type.rstrip("/")
    return is_present(spark, f"{place}/{BATCH}={key}")


def write_batch(rows: DataFrame, table: str, key: str) -> None:
    """Put a batch's rows into its own partition, which is there afterwards even if empty."""
    spark = rows.sparkSession
    columns = [F.col(f"`{name}`") for name in spark.read.table(table).columns]
    with settings(spark, OWN_PARTITION):
        rows.withColumn(BATCH, F.lit(key)).select(*columns).write.mode("overwrite").insertInto(table)
    _register(spark, table, key)


def _register(spark: SparkSession, table: str, key: str) -> None:
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({BATCH} = '{key}')")


def follow(spark: SparkSession, table: str, writer: str, number: int, steps: Sequence[Step]) -> None:
    """Give the rows that a batch wrote to each step."""
    rows = rows_of_batches(spark, table, [f"{writer}-{number}"])
    side_by_side(spark, *[partial(step, rows, writer, number) for step in steps])


def append_batches(
    stream: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    table: str,
    checkpoint: str,
    trigger: Mapping[str, object] = CATCH_UP,
    steps: Sequence[Step] = (),
    expectations: Sequence[Expectation] = (),
    counts: str | None = None,
) -> StreamingQuery:
    """Start writing `build` of each batch to a table partitioned by `batch`.

    Rows that break rules of `expectations` that drop are left out; how many rows broke
    which rule, in all batches, is kept in the folder `counts` for `rule_totals`. Each of
    `steps` then gets the rows as they were written, and must itself be such that a
    batch that is run again changes nothing.
    """
    if expectations and counts is None:
        raise ValueError("expectations need a folder for their counts")
    writer = writer_id(stream.sparkSession, checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        spark, key = batch.sparkSession, f"{writer}-{number}"
        seen = None
        if is_written(spark, table, key):
            _register(spark, table, key)
        elif expectations:
            seen = Observation()
            write_batch(meet(build(batch), expectations, seen), table, key)
        else:
            write_batch(build(batch), table, key)
        if expectations and (seen or not COUNTS.has(spark, counts, writer, number)):
            found = seen.get if seen else build(batch).agg(*all_counts(expectations)).first().asDict()
            rows = [F.struct(*map(F.lit, row)) for row in counts_by_rule(found, expectations)]
            part = spark.range(1).select(F.inline(F.array(*rows))).toDF(*COUNTS.schema.names)
            COUNTS.add(part.withColumn("n", F.col("n").cast("long")), counts, writer, number)
        follow(spark, table, writer, number, steps)

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .queryName(table)
        .trigger(**trigger)
        .foreachBatch(write)
        .start()
    )


def rule_totals(spark: SparkSession, counts: str, metric: str) -> DataFrame:
    """Rows and violations of all batches ever written, as `rule` and `n`."""
    return COUNTS.read(spark, counts).filter(F.col("metric") == metric).select("rule", "n")
