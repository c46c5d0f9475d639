"""Append a streaming DataFrame to a table or folder, exactly once.

What a stateful query's checkpoint depends on (its state partitions, the salts of a
match) is kept in the checkpoint's folder when the query first starts. A later
start goes on with these values, and is refused if it asks for others.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from cardinel.session import STATE_METADATA, STATEFUL, UNCOUNTED, settings
from cardinel.sources.paths import read_if_present

# Take everything that is there, then stop. For a stream that keeps running
# pass, say, {"processingTime": "1 minute"}.
CATCH_UP: Mapping[str, object] = {"availableNow": True}

PARTITIONS = "spark.sql.shuffle.partitions"


class StateChanged(Exception):
    """The query asks for other settings than its checkpoint was begun with."""


def append_to_table(
    df: DataFrame,
    table: str,
    checkpoint: str,
    trigger: Mapping[str, object] = CATCH_UP,
    stateful: bool = False,
    partitions: int | None = None,
    table_format: str = "parquet",
    partition_by: Sequence[str] = (),
    count_state: bool = True,
) -> StreamingQuery:
    """Start appending to a catalog table, from where the checkpoint left off.

    `partitions` is the number of state partitions of a stateful query, for as long as
    its checkpoint lives; by default the session's shuffle partitions. Without
    `count_state`, its progress does not say how many rows are in state.
    """
    writer = _writer(df, checkpoint, trigger, partition_by).queryName(table).format(table_format)
    return _start(
        df, lambda: writer.toTable(table), checkpoint, stateful, partitions, count_state
    )


def append_to_path(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] = CATCH_UP,
    stateful: bool = False,
    partitions: int | None = None,
    table_format: str = "parquet",
    partition_by: Sequence[str] = (),
    count_state: bool = True,
) -> StreamingQuery:
    """Start appending to a folder of files."""
    writer = _writer(df, checkpoint, trigger, partition_by).format(table_format)
    return _start(df, lambda: writer.start(path), checkpoint, stateful, partitions, count_state)


def finish(*queries: StreamingQuery) -> None:
    """Wait for the queries to stop; raises the error of one that failed."""
    for query in queries:
        query.awaitTermination()


def kept_state(spark: SparkSession, checkpoint: str) -> dict | None:
    """What the checkpoint's query began with; None before its first start."""
    kept = read_if_present(lambda: spark.read.text(_place(checkpoint), wholetext=True))
    return None if kept is None else json.loads(kept.first()[0])


def _place(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/state-settings"


def _writer(
    df: DataFrame, checkpoint: str, trigger: Mapping[str, object], partition_by: Sequence[str]
) -> DataStreamWriter:
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).partitionBy(*partition_by)


def _start(
    df: DataFrame,
    start: Callable[[], StreamingQuery],
    checkpoint: str,
    stateful: bool,
    partitions: int | None,
    count_state: bool,
) -> StreamingQuery:
    if not stateful:
        return start()
    spark = df.sparkSession
    asked = {"partitions": partitions, "match": _match_settings(df)}
    kept = kept_state(spark, checkpoint)
    if kept is None:
        kept = {**asked, "partitions": partitions or int(spark.conf.get(PARTITIONS))}
        row = spark.createDataFrame([(json.dumps(kept),)], "value string")
        row.coalesce(1).write.text(_place(checkpoint))
    elif asked["match"] != kept["match"] or partitions not in (None, kept["partitions"]):
        raise StateChanged(f"{checkpoint} was begun with {kept}, not {asked}")
    values = STATEFUL | {PARTITIONS: str(kept["partitions"])}
    with settings(spark, values if count_state else values | UNCOUNTED):
        return start()


def _match_settings(df: DataFrame) -> dict | None:
    found = (field.metadata.get(STATE_METADATA) for field in df.schema)
    return next((value for value in found if value is not None), None)
