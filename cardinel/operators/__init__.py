"""Cleaning, quality rules, alerts and windowed counts."""

from cardinel.operators.alerts import card_alerts, limit_alerts
from cardinel.operators.cleaning import clean_customers, clean_watchlist, parse_transactions
from cardinel.operators.quality import expect_drop, expect_warn, rule_counts
from cardinel.operators.windows import count_sliding, count_tumbling

__all__ = [
    "card_alerts",
    "clean_customers",
    "clean_watchlist",
    "count_sliding",
    "count_tumbling",
    "expect_drop",
    "expect_warn",
    "limit_alerts",
    "parse_transactions",
    "rule_counts",
]
