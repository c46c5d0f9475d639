"""Session settings the jobs rely on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Event times and text timestamps are read and written in UTC everywhere.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}

# For a cluster. Catalyst compares a table's size with the broadcast limit
# before it broadcasts, and adaptive execution compares again with the real
# shuffle sizes; a bigger side goes through a shuffle instead. Adaptive
# execution also splits the partitions of hot join keys and merges small ones,
# in batch queries and in stateless streams.
CLUSTER = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.streaming.stateless.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
}

# For stateful streams: join and window state lives in RocksDB rather than on
# the executors' heaps, within one memory bound for all stores of an executor,
# with one store per partition of a join, and is uploaded to the checkpoint as
# change logs.
STATEFUL = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}

# Without a count of the rows in state, which takes one more lookup for every write.
UNCOUNTED = {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}

# Under this name a frame's columns carry what a checkpoint of it depends on.
STATE_METADATA = "cardinel.state"

# Shuffle partitions to begin with, for each core; adaptive execution merges them
# to the advisory size. Enough for a shuffle of the largest tables to fit in memory
# by parts, few enough for the driver to keep track of.
PARTITIONS_PER_CORE = 4


def prepare(spark: SparkSession, cluster: bool = False) -> SparkSession:
    """Put the required settings (and the cluster ones, if asked) on a session."""
    values = dict(REQUIRED)
    if cluster:
        initial = PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
        values |= CLUSTER
        values["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial)
    for key, value in values.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Set session values for the duration of a block.

    A streaming query copies the session's settings when it starts, so wrapping
    `start()` is enough to give one query its own.
    """
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Only a local session without that setting falls back to a temporary folder,
    because executors on other machines could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/cardinel/{name}-{uuid.uuid4().hex}"
