"""Messages made of a file with one row group are worked on by several tasks."""

from pyspark.sql import functions as F

from cardinel.sources import envelope
from cardinel.streaming import append_to_path, finish
from testbed import mapping

FOLDER = "/root/testdata/sf0.01"


def tasks(df):
    return df.select(F.spark_partition_id()).distinct().count()


def ids(df):
    return sorted(row[0] for row in df.select("transaction_id").collect())


def test_the_file_has_one_row_group(spark):
    assert tasks(mapping.table(spark, FOLDER, "events")) == 1


def test_messages_are_spread_over_tasks(spark):
    rows = mapping.messages(spark, FOLDER)
    assert tasks(rows) == spark.sparkContext.defaultParallelism
    keys = rows.select(F.col("key").cast("string").alias("transaction_id"))
    assert ids(keys) == ids(mapping.transactions(spark, FOLDER))


def test_a_stream_of_messages_is_parsed_by_several_tasks(spark, tmp_path):
    messages = envelope(mapping.messages(spark, FOLDER, stream=True))
    parsed = messages.select("offset", F.spark_partition_id().alias("task"))
    finish(append_to_path(parsed, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.select("task").distinct().count() == spark.sparkContext.defaultParallelism
    assert out.count() == mapping.table(spark, FOLDER, "events").count()
