from collections import Counter

from pyspark.sql import functions as F

from cardinel.operators import card_alerts, limit_alerts
from helpers import customers, transactions, watchlist


def test_limit_is_exclusive(spark):
    rows = transactions(
        spark,
        {"transaction_id": "T1", "amount": 5.0},
        {"transaction_id": "T2", "amount": 5.01},
        {"transaction_id": "T3", "amount": None},
    )
    alerts = limit_alerts(rows, customers(spark, {}))
    assert [row.alert_id for row in alerts.collect()] == ["ALERT-T2"]
    assert len(alerts.columns) == 19


def test_no_limit_or_no_customer_no_alert(spark):
    rows = transactions(spark, {}, {"customer_id": "C9"}, {"customer_id": None})
    assert limit_alerts(rows, customers(spark, {"transaction_limit": None})).count() == 0


def test_duplicates_are_kept(spark):
    rows = transactions(spark, {}, {})
    assert limit_alerts(rows, customers(spark, {})).count() == 2
    twice = limit_alerts(transactions(spark, {}), customers(spark, {}, {"last_name": "Ray"}))
    assert {row.customer_name for row in twice.collect()} == {"Ann Lee", "Ann Ray"}
    assert twice.select("alert_id").distinct().count() == 1
    entries = watchlist(spark, {}, {"watchlist_id": "WL000002"})
    both = card_alerts(rows, entries, customers(spark, {}, {}))
    assert both.count() == 2 * 2 * 2


def test_unknown_customer_still_gives_a_card_alert(spark):
    rows = transactions(spark, {"customer_id": "C9"}, {"customer_id": None})
    alerts = card_alerts(rows, watchlist(spark, {}), customers(spark, {})).collect()
    assert [(row.customer_email, row.customer_name) for row in alerts] == [(None, "")] * 2
    assert alerts[0].alert_id == "FRAUD-T1-WL000001"
    assert len(alerts[0]) == 32


def test_only_the_card_decides(spark):
    entries = watchlist(
        spark,
        {"status": "INACTIVE", "watch_type": "DEVICE"},
        {"watchlist_id": "WL000002", "effective_from": "01-Jan-2030 00:00:00"},
        {"watchlist_id": "WL000003", "effective_from": None},
        {"watchlist_id": "WL000004", "entity_id": "4111"},
        {"watchlist_id": "WL000005", "entity_id": None},
    )
    alerts = card_alerts(transactions(spark, {}), entries, customers(spark, {}))
    assert {row.watchlist_id for row in alerts.collect()} == {"WL000001", "WL000002", "WL000003"}


def test_lower_case_card_never_matches(spark):
    entries = watchlist(spark, {"entity_id": "abc"})
    cards = transactions(spark, {"card_number": "abc"}, {"card_number": "ABC"})
    assert card_alerts(cards, entries, customers(spark, {})).count() == 1


def test_salted_match_equals_plain_match(spark):
    """One card holds a third of the transactions, another a third of the entries."""
    numbers = spark.range(900)
    cards = numbers.select(
        F.format_string("T%d", "id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.format_string("K%d", F.col("id") % 50))
        .alias("card_number"),
    )
    base = transactions(spark, {}).drop("transaction_id", "card_number")
    rows = cards.join(F.broadcast(base))
    entries = [
        {"watchlist_id": f"WL{i}", "entity_id": "K1" if i % 3 == 0 else ("HOT", f"K{i}")[i % 2]}
        for i in range(30)
    ]
    listed = watchlist(spark, *entries)
    got = {
        salts: Counter(
            row.alert_id
            for row in card_alerts(rows, listed, customers(spark, {}), salts=salts).collect()
        )
        for salts in (1, 2, 7)
    }
    by_card = Counter(entry["entity_id"] for entry in entries)
    brute = sum(by_card[row.card_number] for row in cards.collect())
    assert sum(got[1].values()) == brute > 900
    assert got[1] == got[2] == got[7]
