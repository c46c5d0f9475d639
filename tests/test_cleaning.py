import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardinel.operators import (
    clean_customers,
    expect_drop,
    parse_transactions,
    rule_counts,
)
from cardinel.operators.quality import CUSTOMER_DROP, TRANSACTION_DROP, TRANSACTION_WARN
from helpers import customers, transactions, watchlist

KEYS = (
    '"transaction_id":"T1","customer_id":"C1","card_number":"4","merchant_id":"M1",'
    '"transaction_timestamp":"2024-01-01T00:00:07.179575Z"'
)


def parsed(spark, *values):
    bronze = spark.createDataFrame([(value,) for value in values], "value string").select(
        "value",
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(7).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.current_timestamp().alias("ingestion_ts"),
    )
    return parse_transactions(bronze)


@pytest.mark.parametrize("value", ["not json", "", None, "{}", '{"transaction_id":"T1"}', "[1]"])
def test_unusable_messages_are_dropped(spark, value):
    rows = parsed(spark, value)
    assert rows.count() == 1
    assert expect_drop(rows, TRANSACTION_DROP, "drop").count() == 0
    assert expect_drop(rows, TRANSACTION_DROP).count() == 0


def test_wrong_type_nulls_only_that_field(spark):
    row = parsed(spark, "{" + KEYS + ',"amount":"12.5","city":5,"extra":1}').first()
    assert row.amount is None
    assert row.city == "5"
    assert row.transaction_id == "T1"
    assert row.kafka_offset == 7
    assert row.transaction_timestamp == dt.datetime(2024, 1, 1, 0, 0, 7, 179575)


def test_warn_rule_counts_and_keeps(spark):
    rows = transactions(
        spark, {"amount": 0.0}, {"amount": -5.0}, {"amount": None}, {"amount": 1.0}
    )
    counts = rule_counts(rows, {**TRANSACTION_WARN, **TRANSACTION_DROP}).first()
    assert counts["rows"] == 4
    assert counts.valid_transaction_amount == 3
    assert expect_drop(rows, TRANSACTION_DROP).count() == 4


def test_message_text_is_parsed_once(spark, tmp_path):
    """The counted rules stand between parsing and filter, so that the filter is not
    moved down and the text not parsed again for every rule."""
    parsed(spark, "{" + KEYS + "}").select("*").write.parquet(str(tmp_path / "x"))
    rows = spark.read.parquet(str(tmp_path / "x")).select(F.to_json(F.struct("*")).alias("value"))
    rows = rows.select(
        "value",
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.current_timestamp().alias("ingestion_ts"),
    )
    checked = expect_drop(parse_transactions(rows), TRANSACTION_DROP, "drop")
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize(
    "text, parsed",
    [
        ("05-Mar-2024 10:00:00", dt.datetime(2024, 3, 5, 10)),
        ("05-MAR-2024 10:00:00", dt.datetime(2024, 3, 5, 10)),
        ("5-Mar-2024 10:00:00", None),
        ("x", None),
        ("", None),
        (None, None),
    ],
)
def test_effective_from(spark, text, parsed):
    assert watchlist(spark, {"effective_from": text}).first().effective_from == parsed


def test_watchlist_codes_in_upper_case(spark):
    row = watchlist(
        spark,
        {
            "watchlist_id": "wl000002",
            "entity_id": "abc",
            "action": "block",
            "risk_level": "low",
            "watch_type": "card",
            "status": "active",
        },
    ).first()
    assert (row.watchlist_id, row.entity_id, row.action, row.risk_level) == (
        "WL000002",
        "ABC",
        "BLOCK",
        "LOW",
    )
    assert (row.watch_type, row.status) == ("card", "active")


@pytest.mark.parametrize(
    "text, parsed",
    [("2020-02-29", dt.date(2020, 2, 29)), ("2021-02-29", None), ("x", None), (None, None)],
)
def test_account_open_date(spark, text, parsed):
    row = clean_customers(customers(spark, {"account_open_date": text})).first()
    assert row.account_open_date == parsed


def test_customers_without_id_are_dropped(spark):
    rows = clean_customers(customers(spark, {}, {"customer_id": None}))
    assert expect_drop(rows, CUSTOMER_DROP).count() == 1
    assert len(rows.columns) == 23
