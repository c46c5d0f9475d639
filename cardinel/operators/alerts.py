"""Alerts: a transaction over its customer's limit, or a card on the watchlist.

Neither join removes duplicates: a customer with two records, or a card with
two watchlist entries, gives two alerts per transaction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardinel.functions import alert_id, full_name
from cardinel.operators.skew import copy_to_salts, spread_over_salts
from cardinel.operators.windows import EVENT_TIME, LATENESS
from cardinel.session import STATE_METADATA

# Prefixes of the alert ids, and the alert types.
LIMIT_PREFIX = "ALERT"
LIMIT_TYPE = "LIMIT_EXCEEDED_TRANSACTION"
CARD_PREFIX = "FRAUD"
CARD_TYPE = "FRAUD_WATCHLIST_MATCH"

_CUSTOMER = ["customer_id", "email", "first_name", "last_name"]


def limit_alerts(
    transactions: DataFrame, customers: DataFrame, now: Column | None = None
) -> DataFrame:
    """One alert per transaction above its customer's limit.

    Transactions without a customer, an amount or a limit raise none. The
    transactions may be a stream, with customers as a table. Catalyst broadcasts
    the customers if their size allows; otherwise both sides are shuffled by
    customer and adaptive execution splits the partitions of hot customers.
    """
    limits = customers.select(*_CUSTOMER, "transaction_limit")
    return (
        transactions.join(limits, "customer_id")
        .filter(F.col("amount") > F.col("transaction_limit"))
        .select(
            alert_id(LIMIT_PREFIX, "transaction_id").alias("alert_id"),
            F.lit(LIMIT_TYPE).alias("alert_type"),
            _now(now).alias("alert_timestamp"),
            "transaction_id",
            "customer_id",
            F.col("email").alias("customer_email"),
            full_name("first_name", "last_name").alias("customer_name"),
            F.col("amount").alias("transaction_amount"),
            "transaction_limit",
            "currency",
            "merchant_name",
            "merchant_category",
            "transaction_type",
            "payment_channel",
            "city",
            "country",
            "is_international",
            "transaction_timestamp",
            "status",
        )
    )


def match_cards(
    transactions: DataFrame,
    watchlist: DataFrame,
    lateness: str = LATENESS,
    salts: int = 1,
    hot: Sequence[str] | None = None,
) -> DataFrame:
    """Every pair of a transaction and a watchlist entry for its card.

    Only the card decides: kind, status, action and effective time of the entry
    do not. Entries are in upper case, so a card in lower case never matches.

    With two streams, both sides are kept as state and match in either order of
    arrival; a row older than the watermark of the two event times is dropped.
    Transactions stay in state for good, as any later entry may name their card.
    As a stateful query gets no adaptive split of hot keys, the transactions of the
    `hot` cards (all cards, if None) are spread over `salts` parts, with a copy of the
    card's entries in each part. The result does not depend on that, but a checkpoint
    does, as it does on the order of the two sides: these go with the result as
    metadata, the runner keeps them with the checkpoint, and it refuses to go on with
    others.
    """
    seen = transactions.withWatermark(EVENT_TIME, lateness)
    listed = watchlist.withWatermark("effective_from", lateness)
    on = F.col("t.card_number") == F.col("w.entity_id")
    if salts > 1:
        by = ["transaction_id", EVENT_TIME, "amount"]
        seen = spread_over_salts(seen, "card_number", by, salts, hot)
        listed = copy_to_salts(listed, "entity_id", salts, hot)
        on &= F.col("t.salt") == F.col("w.salt")
    state = {"salts": salts, "hot": None if hot is None else [*hot], "first": "watchlist"}
    # Entries come first: a batch takes in its left side before its right one, and a row
    # that is found in state for the first time is written there again, as matched. With
    # entries in state, a payment is written once, when its match is already known.
    # Both event times stay in the result; were one left out, the optimizer
    # would remove it above the watermark and its late rows would get through.
    return (
        listed.alias("w")
        .join(seen.alias("t"), on)
        .select(
            "t.transaction_id",
            "t.customer_id",
            "t.card_number",
            "t.amount",
            "t.currency",
            "t.merchant_id",
            "t.merchant_name",
            "t.merchant_category",
            "t.transaction_type",
            "t.payment_channel",
            "t.device_id",
            F.col("t.city").alias("transaction_city"),
            F.col("t.country").alias("transaction_country"),
            "t.transaction_timestamp",
            "t.is_international",
            F.col("t.status").alias("transaction_status"),
            F.col("w.watchlist_id").alias("watchlist_id", metadata={STATE_METADATA: state}),
            "w.watch_type",
            "w.risk_level",
            "w.action",
            "w.reason_code",
            "w.reason_description",
            F.col("w.effective_from").alias("watchlist_effective_from"),
            "w.reported_by",
            "w.reported_source",
            F.col("w.city").alias("watchlist_city"),
            F.col("w.country").alias("watchlist_country"),
        )
    )


def alert_matches(
    matches: DataFrame, customers: DataFrame, now: Column | None = None
) -> DataFrame:
    """Card matches with their customer; unknown customers have no e-mail."""
    ids = ["transaction_id", "customer_id"]
    rest = [name for name in matches.columns if name not in ids]
    return matches.join(customers.select(*_CUSTOMER), "customer_id", "left").select(
        alert_id(CARD_PREFIX, "transaction_id", "watchlist_id").alias("alert_id"),
        F.lit(CARD_TYPE).alias("alert_type"),
        _now(now).alias("alert_timestamp"),
        *ids,
        F.col("email").alias("customer_email"),
        full_name("first_name", "last_name").alias("customer_name"),
        *rest,
    )


def card_alerts(
    transactions: DataFrame,
    watchlist: DataFrame,
    customers: DataFrame,
    now: Column | None = None,
    lateness: str = LATENESS,
    salts: int = 1,
) -> DataFrame:
    """One alert per transaction, watchlist entry of its card and customer record.

    With two streams and customers too large to broadcast, run `match_cards` and
    `alert_matches` as two queries: the second one keeps no state and so gets
    adaptive execution, which splits hot customers.
    """
    matches = match_cards(transactions, watchlist, lateness, salts)
    return alert_matches(matches, customers, now)


def _now(now: Column | None) -> Column:
    return F.current_timestamp() if now is None else now
