"""What the plans of the main operators read, move and keep in state."""

import re

import pytest

from cardinel.operators import count_sliding, count_tumbling, expect_drop, limit_alerts
from cardinel.operators.alerts import alert_matches, match_cards
from cardinel.operators.quality import TRANSACTION_DROP
from cardinel.plans import dashboard
from cardinel.session import settings
from cardinel.streaming import append_to_path, finish
from helpers import Feed, customers, transactions, watchlist


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stored")
    frames = {
        "transactions": transactions(spark, {}, {"transaction_id": "T2"}),
        "customers": customers(spark, {}),
        "watchlist": watchlist(spark, {}),
    }
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in frames}


def plan(df):
    return df._jdf.queryExecution().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def columns_read(df):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", physical_full(df))
    return [len(schema.split(",")) if schema else 0 for schema in schemas]


def physical_full(df):
    spark = df.sparkSession
    with settings(spark, {"spark.sql.maxMetadataStringLength": "10000"}):
        return df.select("*")._jdf.queryExecution().executedPlan().toString()


def test_rules_reach_the_scan(stored):
    checked = expect_drop(stored["transactions"], TRANSACTION_DROP)
    pushed = re.search(r"PushedFilters: \[(.*?)\]", physical_full(checked)).group(1)
    for name in ("transaction_id", "customer_id", "card_number", "merchant_id"):
        assert f"IsNotNull({name})" in pushed


@pytest.mark.parametrize(
    "query, read",
    [
        (dashboard.total_transactions, 0),
        (dashboard.total_volume, 1),
        (dashboard.txn_by_channel, 1),
        (dashboard.top_cities, 1),
        (dashboard.transaction_overview, 5),
        (count_tumbling, 1),
        (count_sliding, 1),
    ],
)
def test_reports_read_only_their_columns(stored, query, read):
    assert columns_read(query(stored["transactions"])) == [read]


def test_alerts_read_only_their_columns(stored):
    assert columns_read(limit_alerts(stored["transactions"], stored["customers"])) == [13, 5]


def test_top_reports_do_not_sort_everything(stored):
    for query in (dashboard.top_cities, dashboard.txn_by_merchant):
        assert "TakeOrderedAndProject" in physical(query(stored["transactions"]))
    alerts = limit_alerts(stored["transactions"], stored["customers"])
    assert "TakeOrderedAndProject" in physical(dashboard.recent_limit_alerts(alerts))


def test_sliding_windows_copy_counts_not_rows(stored):
    text = plan(count_sliding(stored["transactions"]))
    optimized = text[text.index("Optimized") : text.index("Physical")]
    assert optimized.index("Expand") < optimized.rindex("Aggregate")


def test_big_sides_are_shuffled_not_broadcast(spark, stored):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for df in (
            limit_alerts(stored["transactions"], stored["customers"]),
            alert_matches(
                match_cards(stored["transactions"], stored["watchlist"]), stored["customers"]
            ),
        ):
            text = physical(df)
            assert "Broadcast" not in text and "Cartesian" not in text
            assert "SortMergeJoin" in text


def test_state_of_a_match_has_only_the_columns_of_the_result(spark, stored, tmp_path):
    """No fields that the alerts do not show, and the card and salt to join by."""
    feeds = []
    for name in ("transactions", "watchlist"):
        feeds.append(Feed(spark, tmp_path / name, stored[name].schema).add(stored[name]).stream())
    matches = match_cards(*feeds, salts=4)
    query = append_to_path(
        matches, str(tmp_path / "out"), str(tmp_path / "checkpoint"), stateful=True
    )
    finish(query)
    text = query._jsq.explainInternal(False)
    assert "StreamingSymmetricHashJoin" in text
    for absent in ("_rescued_data", "source_file", "ingestion_timestamp", "first_name"):
        assert absent not in text[: text.index("FileScan")]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
