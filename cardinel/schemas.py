"""Column names and types of the messages and files the library reads."""

from __future__ import annotations

from pyspark.sql import types as T


def _columns(**kinds: str) -> T.StructType:
    schema = T.StructType()
    for name, kind in kinds.items():
        schema = schema.add(name, kind)
    return schema


# The message envelope, as the Kafka connector delivers it once
# key and value have been cast to text.
ENVELOPE = _columns(
    key="string",
    value="string",
    topic="string",
    partition="integer",
    offset="long",
    timestamp="timestamp",
    timestampType="integer",
)

# The JSON payload of a card transaction.
TRANSACTION = _columns(
    transaction_id="string",
    customer_id="string",
    card_number="string",
    merchant_id="string",
    merchant_name="string",
    merchant_category="string",
    amount="double",
    currency="string",
    transaction_type="string",
    payment_channel="string",
    device_id="string",
    city="string",
    country="string",
    transaction_timestamp="timestamp",
    is_international="boolean",
    status="string",
)

# One watchlist entry, as landed in a JSON file.
WATCHLIST = _columns(
    watchlist_id="string",
    watch_type="string",
    entity_id="string",
    action="string",
    city="string",
    country="string",
    effective_from="string",
    reason_code="string",
    reason_description="string",
    reported_by="string",
    reported_source="string",
    risk_level="string",
    status="string",
)

# A customer record before cleaning.
CUSTOMER = _columns(
    customer_id="string",
    first_name="string",
    last_name="string",
    gender="string",
    age="integer",
    city="string",
    state="string",
    country="string",
    annual_income="double",
    customer_segment="string",
    account_open_date="string",
    risk_score="double",
    preferred_spending_min="double",
    preferred_spending_max="double",
    preferred_city="string",
    preferred_country="string",
    trusted_device_id="string",
    card_number="string",
    card_type="string",
    email="string",
    transaction_limit="double",
    update_timestamp="timestamp",
)
