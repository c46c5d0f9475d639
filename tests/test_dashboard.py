from cardinel.operators import count_tumbling
from cardinel.plans import dashboard
from helpers import customers, transactions, watchlist
from cardinel.operators import card_alerts, limit_alerts


def test_missing_flag_is_a_second_domestic_group(spark):
    rows = transactions(
        spark,
        {"is_international": True},
        {"is_international": False},
        {"is_international": None},
        {"is_international": None},
    )
    counts = dashboard.intl_vs_domestic(rows)
    assert sorted(map(tuple, counts.collect())) == [
        ("Domestic", 1),
        ("Domestic", 2),
        ("International", 1),
    ]
    assert sorted(map(tuple, dashboard.widget_totals(counts).collect())) == [
        ("Domestic", 3),
        ("International", 1),
    ]


def test_ties_at_the_cut_are_broken_by_label(spark):
    rows = transactions(spark, *[{"city": f"C{n:02}"} for n in range(12)], {"city": "C11"})
    cities = [row.city for row in dashboard.top_cities(rows).collect()]
    assert cities == ["C11"] + [f"C{n:02}" for n in range(9)]


def test_missing_labels_are_a_group(spark):
    rows = transactions(spark, {"payment_channel": None}, {"payment_channel": "POS"}, {})
    assert sorted(map(str, dashboard.txn_by_channel(rows).collect())) == [
        "Row(payment_channel='POS', transaction_count=1)",
        "Row(payment_channel=None, transaction_count=2)",
    ]


def test_empty_tables(spark):
    rows = transactions(spark)
    assert dashboard.total_transactions(rows).first()[0] == 0
    assert dashboard.total_volume(rows).first()[0] is None
    alerts = limit_alerts(rows, customers(spark))
    assert dashboard.limit_exceeded_count(alerts).first()[0] == 0
    assert dashboard.recent_limit_alerts(alerts).count() == 0


def test_all_datasets_equal_the_single_ones(spark):
    rows = transactions(
        spark,
        *[
            {
                "transaction_id": f"T{n}",
                "city": f"C{n % 13}" if n % 7 else None,
                "merchant_category": f"K{n % 3}",
                "payment_channel": None if n % 4 == 0 else "POS",
                "is_international": (True, False, None)[n % 3],
                "amount": n * 10_000.0 if n % 9 else None,
            }
            for n in range(60)
        ],
    )
    minutes = count_tumbling(rows)
    limits = limit_alerts(rows, customers(spark, {}))
    cards = card_alerts(rows, watchlist(spark, {}), customers(spark, {}))
    got = dashboard.datasets(rows, minutes, limits, cards)
    assert len(got) == 13
    sources = {
        "txn_by_minute": minutes,
        "limit_exceeded_count": limits,
        "recent_limit_alerts": limits,
        "fraud_card_alerts_count": cards,
        "fraud_by_reason": cards,
        "fraud_by_risk": cards,
        "recent_fraud_alerts": cards,
    }
    for name, df in got.items():
        single = getattr(dashboard, name)(sources.get(name, rows))
        skip = "alert_timestamp"
        assert sorted(map(str, df.drop(skip).collect())) == sorted(
            map(str, single.drop(skip).collect())
        ), name
    assert len(got["recent_limit_alerts"].columns) == 12
    assert len(got["recent_fraud_alerts"].columns) == 13
    assert got["recent_limit_alerts"].count() == 50
