"""Hot keys: adaptive execution splits them in batch queries and stateless streams."""

import pytest
from pyspark.sql import functions as F

from cardinel.operators import limit_alerts
from cardinel.operators.alerts import alert_matches
from cardinel.session import settings
from cardinel.streaming import append_to_path, finish
from helpers import Feed, customers, transactions

# Thresholds cut down to the size of the data, and no broadcast.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """A third of the transactions belong to one customer."""
    folder = str(tmp_path_factory.mktemp("hot"))
    numbers = spark.range(0, 120_000, 1, 16)
    third = F.col("id") % 3 == 0
    base = transactions(spark, {}).drop("transaction_id", "customer_id", "amount")
    numbers.select(
        F.format_string("T%010d", "id").alias("transaction_id"),
        F.when(third, "C0").otherwise(F.format_string("C%d", F.col("id") % 1000))
        .alias("customer_id"),
        (F.col("id") % 200).cast("double").alias("amount"),
    ).join(F.broadcast(base)).select(*transactions(spark).columns).write.parquet(folder + "/t")
    people = spark.range(1000).select(F.format_string("C%d", "id").alias("customer_id"))
    rest = customers(spark, {"transaction_limit": 100.0}).drop("customer_id")
    people.join(F.broadcast(rest)).select(*customers(spark).columns).write.parquet(folder + "/c")
    return folder


def test_batch(spark, hot):
    with settings(spark, SMALL):
        rows, people = spark.read.parquet(hot + "/t"), spark.read.parquet(hot + "/c")
        alerts = limit_alerts(rows, people)
        assert len(alerts.collect()) == rows.filter("amount > 100").count()
        assert "skew=true" in alerts._jdf.queryExecution().executedPlan().toString()


def test_stateless_streams(spark, hot, tmp_path):
    people = spark.read.parquet(hot + "/c")
    feed = Feed(spark, hot + "/t", transactions(spark).schema)
    matches = feed.stream().select(
        "transaction_id", "customer_id", F.lit("WL1").alias("watchlist_id")
    )
    plans = {
        "limit": limit_alerts(feed.stream(), people),
        "card": alert_matches(matches, people),
    }
    with settings(spark, SMALL):
        for name, alerts in plans.items():
            query = append_to_path(alerts, str(tmp_path / name), str(tmp_path / f"{name}.c"))
            finish(query)
            assert "skew=true" in query._jsq.explainInternal(False)
    assert spark.read.parquet(str(tmp_path / "card")).count() == 120_000
