from pyspark.sql import functions as F

from cardinel.functions import mask_card, money, risk_colour, shown, shown_time, yes_no
from cardinel.operators import card_alerts, limit_alerts
from cardinel.plans.notifications import (
    notification_counts,
    render_card_notifications,
    render_limit_notifications,
)
from cardinel.streaming import (
    attach_outbox,
    finish,
    outbox_stats,
    read_outbox,
    write_outbox,
)
from helpers import Feed, at, customers, transactions, watchlist


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_mask(spark):
    for card, shown_card in {
        "4111222233334444": "**** **** **** 4444",
        "1234": "**** **** **** 1234",
        "12": "****",
        "": "****",
        None: "****",
    }.items():
        assert value(spark, mask_card(F.lit(card).cast("string"))) == shown_card


def test_risk_colour(spark):
    for level, colour in {
        "CRITICAL": "#b91c1c",
        "High": "#d9534f",
        "medium": "#f0ad4e",
        "low": "#5cb85c",
        "X": "#6c757d",
        None: "#6c757d",
    }.items():
        assert value(spark, risk_colour(F.lit(level).cast("string"))) == colour


def test_flags_money_and_times(spark):
    flags = [value(spark, yes_no(F.lit(flag).cast("boolean"))) for flag in (True, False, None)]
    assert flags == ["Yes", "No", "No"]
    for amount in (0.0, 2.005, 0.125, 1234567.891, -5.5, 1e9, 0.015):
        assert value(spark, money(F.lit(amount))) == f"{amount:,.2f}"
    assert value(spark, money(F.lit(None).cast("double"))) is None
    assert value(spark, shown(F.lit(None))) == "None"
    for text in ("2024-01-01 00:00:00", "2024-01-01 00:00:00.500000", "2024-01-01 10:20:30.000007"):
        assert value(spark, shown_time(F.lit(text).cast("timestamp"))) == text
    assert value(spark, shown_time(F.lit(None).cast("timestamp"))) == "None"


def card_mails(spark, rows, people=({},), entries=({},)):
    alerts = card_alerts(
        transactions(spark, *rows), watchlist(spark, *entries), customers(spark, *people)
    )
    return render_card_notifications(alerts)


def test_card_mail(spark):
    mail = card_mails(spark, [{"amount": 1234.5, "is_international": None}]).first()
    assert mail.recipient == "ann@example.com"
    assert mail.subject == "🚨 Fraud Card Alert [HIGH] - FRAUD-T1-WL000001"
    assert mail.deliverable
    assert "4111222233334444" not in mail.body
    for text in ("**** **** **** 4444", "USD 1,234.50", "#d9534f", "Ann Lee", "<td>No</td>",
                 "2023-01-01 00:00:00", "Here, There"):
        assert text in mail.body


def test_undeliverable(spark):
    mails = card_mails(
        spark,
        [
            {"transaction_id": "T1"},
            {"transaction_id": "T2", "amount": None},
            {"transaction_id": "T3", "customer_id": "C9"},
            {"transaction_id": "T4", "customer_id": "C2"},
        ],
        people=({}, {"customer_id": "C2", "email": ""}),
    )
    got = {row.alert_id[6:8]: row.deliverable for row in mails.collect()}
    assert got == {"T1": True, "T2": False, "T3": False, "T4": False}


def test_limit_mail(spark):
    alerts = limit_alerts(transactions(spark, {"amount": 99.999}), customers(spark, {}))
    mail = render_limit_notifications(alerts).first()
    assert mail.subject == "⚠️ Limit-Exceeded Transaction Alert - ALERT-T1"
    assert "USD 100.00" in mail.body and "USD 5.00" in mail.body
    assert "2024-01-01 00:00:30<" in mail.body


def test_replayed_batch_is_in_the_outbox_once(spark, tmp_path):
    folder = str(tmp_path / "outbox")
    mails = card_mails(spark, [{}, {"amount": None}])
    for batch in (0, 1, 1):
        write_outbox(mails, folder, "q", batch)
    stats = {row.batch_id: row for row in outbox_stats(read_outbox(spark, folder)).collect()}
    assert {batch: tuple(row)[2:] for batch, row in stats.items()} == {
        0: (2, 1, 1),
        1: (2, 1, 1),
    }


def test_outbox_follows_the_stream(spark, tmp_path):
    people = customers(spark, {})
    feed = Feed(spark, tmp_path / "t", transactions(spark).schema)
    folder, checkpoint = str(tmp_path / "outbox"), str(tmp_path / "checkpoint")

    def run(enabled=True):
        alerts = limit_alerts(feed.stream(), people)
        finish(
            attach_outbox(alerts, render_limit_notifications, folder, checkpoint, enabled)
        )

    assert read_outbox(spark, folder).count() == 0
    feed.add(transactions(spark, {"transaction_id": "T1"}))
    run()
    feed.add(transactions(spark, {"transaction_id": "T2"}))
    run(enabled=False)
    feed.add(
        transactions(
            spark, {"transaction_id": "T3", "transaction_timestamp": at("2024-01-02 00:00:00")}
        )
    )
    run()
    got = {(row.batch_id, row.alert_id) for row in read_outbox(spark, folder).collect()}
    assert got == {(0, "ALERT-T1"), (2, "ALERT-T3")}

    # A new checkpoint begins at batch 0 again, and leaves the old mail alone.
    alerts = limit_alerts(feed.stream(), people)
    finish(attach_outbox(alerts, render_limit_notifications, folder, checkpoint + "2"))
    assert read_outbox(spark, folder).count() == 2 + 3


def test_counting_renders_nothing(spark):
    plan = notification_counts(card_mails(spark, [{}]))._jdf.queryExecution().optimizedPlan()
    assert "html" not in plan.toString() and "format_number" not in plan.toString()
