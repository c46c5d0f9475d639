"""Reading what may not be there yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def read_if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What `read` gives, or None if its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def is_present(spark: SparkSession, folder: str) -> bool:
    """Whether a folder is there, wherever Spark can read one."""
    system, path = _located(spark, folder)
    return system.exists(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder, wherever Spark can read one; nothing happens if it is not there."""
    system, path = _located(spark, folder)
    system.delete(path, True)


def _located(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path
