"""Counts stated for the mapping in FIXTURES.md, taken from that file's own SQL."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cardinel.operators import card_alerts, clean_watchlist, expect_drop, limit_alerts, rule_counts
from cardinel.operators.quality import TRANSACTION_DROP, TRANSACTION_WARN
from cardinel.plans import dashboard

TEXT = (Path(__file__).resolve().parents[1] / "FIXTURES.md").read_text()


def mapped(spark, folder, title):
    sql = re.search(rf"### {title}\n+```sql\n(.*?)```", TEXT, re.S).group(1)
    for name in ("events", "customer", "nation"):
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)
    return spark.sql(sql)


@pytest.mark.parametrize(
    "scale, kept, warned, limit, card, unknown, scopes, volume",
    [
        ("0.001", 989, 12, 137, 219, 58, [9, 98, 882], 0.05),
        ("0.01", 9896, 113, 904, 1436, 119, [98, 980, 8818], 0.48),
    ],
)
def test_counts(spark, scale, kept, warned, limit, card, unknown, scopes, volume):
    folder = f"/root/testdata/sf{scale}"
    raw = mapped(spark, folder, "transactions").withColumn(
        "transaction_timestamp", F.col("transaction_timestamp").cast("timestamp")
    )
    people = mapped(spark, folder, "customers")
    entries = mapped(spark, folder, r"watchlist \(raw\)")
    for name in ("_rescued_data", "file_path", "ingestion_ts"):
        entries = entries.withColumn(name, F.lit(None).cast("string"))
    rows = expect_drop(raw, TRANSACTION_DROP)
    assert rows.count() == kept
    assert rule_counts(raw, TRANSACTION_WARN).first().valid_transaction_amount == warned
    assert limit_alerts(rows, people).count() == limit
    cards = card_alerts(rows, clean_watchlist(entries), people)
    assert cards.count() == card
    assert cards.filter("customer_email is null").count() == unknown
    counts = dashboard.intl_vs_domestic(rows).collect()
    assert sorted(row.transaction_count for row in counts) == scopes
    assert dashboard.total_volume(rows).first()[0] == volume
