"""The given tables as card transactions, customers and watchlist entries.

The expressions run unchanged in Spark and in the engine that checks the
results. Every row of a table is used:
each event is a transaction, each customer a customer record and each supplier
a watchlist entry for the card of the same number. Some transactions lack a
customer, have no or a negative amount, some customers lack an id, and watchlist
codes are in lower case, so that the cleaning has something to do. A tenth of the cards
has a letter, in lower case for half of the payments, which then match nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardinel.schemas import TRANSACTION

SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}

TRANSACTIONS = {
    "transaction_id": "concat('T', lpad(cast(event_id as string), 10, '0'))",
    "customer_id": """case when event_id % 97 = 0 then null
        else concat('C', lpad(cast(user_id as string), 8, '0')) end""",
    "card_number": """concat(case when user_id % 10 <> 0 then '4' when event_id % 2 = 0 then 'X'
        else 'x' end, lpad(cast(user_id as string), 15, '0'))""",
    "merchant_id": "concat('M', cast(event_id % 50 as string))",
    "merchant_name": "concat('Merchant ', cast(event_id % 50 as string))",
    "merchant_category": "event_type",
    "amount": """case when event_id % 89 = 0 then -value when event_id % 83 <> 0 then value end""",
    "currency": "case event_id % 4 when 0 then 'EUR' when 1 then 'GBP' else 'USD' end",
    "transaction_type": "case when event_id % 2 = 0 then 'PURCHASE' else 'WITHDRAWAL' end",
    "payment_channel": "case event_id % 3 when 0 then 'POS' when 1 then 'ONLINE' else 'ATM' end",
    "device_id": "concat('D', cast(event_id % 20 as string))",
    "city": "concat('CITY_', cast(event_id % 25 as string))",
    "country": "concat('NATION_', cast(event_id % 5 as string))",
    "transaction_timestamp": "cast(ts as timestamp)",
    "is_international": "case when event_id % 101 = 0 then null else event_id % 10 = 0 end",
    "status": "'APPROVED'",
}

CUSTOMERS = {
    "customer_id": """case when c_acctbal < 0 then null
        else concat('C', lpad(cast(c_custkey as string), 8, '0')) end""",
    "first_name": "'Customer'",
    "last_name": "lpad(cast(c_custkey as string), 9, '0')",
    "gender": "case when c_custkey % 2 = 0 then 'F' else 'M' end",
    "age": "cast(18 + c_custkey % 60 as int)",
    "city": "concat('CITY_', cast(c_nationkey as string))",
    "state": "concat('STATE_', cast(n_regionkey as string))",
    "country": "n_name",
    "annual_income": "c_acctbal * 12",
    "customer_segment": "c_mktsegment",
    "account_open_date": """case when c_nationkey = 3 then 'unknown'
        else concat('2020-', lpad(cast(c_custkey % 12 + 1 as string), 2, '0'), '-',
                    lpad(cast(c_custkey % 28 + 1 as string), 2, '0')) end""",
    "risk_score": "cast(c_custkey % 100 as double)",
    "preferred_spending_min": "cast(1 as double)",
    "preferred_spending_max": "cast(100 as double)",
    "preferred_city": "concat('CITY_', cast(c_custkey % 25 as string))",
    "preferred_country": "n_name",
    "trusted_device_id": "concat('D', cast(c_custkey % 20 as string))",
    "card_number": "concat('4', lpad(cast(c_custkey as string), 15, '0'))",
    "card_type": "case when c_custkey % 2 = 0 then 'DEBIT' else 'CREDIT' end",
    "email": """case when c_mktsegment = 'FURNITURE' then null
        else concat('c', cast(c_custkey as string), '@example.com') end""",
    "transaction_limit": "c_acctbal / 20",
    "update_timestamp": "cast('2024-01-01 00:00:00' as timestamp)",
}
HOME = "c_nationkey = n_nationkey"

WATCHLIST_ENTRIES = {
    "watchlist_id": "concat('wl', lpad(cast(s_suppkey as string), 6, '0'))",
    "watch_type": "'CARD'",
    "entity_id": """concat(case when s_suppkey % 10 = 0 then 'x' else '4' end,
        lpad(cast(s_suppkey as string), 15, '0'))""",
    "action": "'block'",
    "city": "concat('CITY_', cast(s_nationkey as string))",
    "country": "concat('NATION_', cast(s_nationkey as string))",
    "effective_from": """case when s_acctbal < 0 then 'unknown'
        else concat(lpad(cast(s_suppkey % 28 + 1 as string), 2, '0'),
                    '-Jan-2023 00:00:00') end""",
    "reason_code": """case s_suppkey % 3 when 0 then 'STOLEN' when 1 then 'CLONED'
        else 'LEAKED' end""",
    "reason_description": "'reported by issuer'",
    "reported_by": "'OPS'",
    "reported_source": "'BANK'",
    "risk_level": """case s_suppkey % 4 when 0 then 'critical' when 1 then 'high'
        when 2 then 'medium' else 'low' end""",
    "status": "'ACTIVE'",
}


def table(spark: SparkSession, folder: str, name: str, stream: bool = False) -> DataFrame:
    """A given table, as a table or as a stream of its files."""
    if stream:
        # The braces make the path a pattern, which may name a file or a folder.
        path = f"{folder}/{name}{{.parquet}}"
        return spark.readStream.schema(SCHEMAS[name]).parquet(path)
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def transactions(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    return _as_transactions(table(spark, folder, "events", stream))


def _as_transactions(events: DataFrame) -> DataFrame:
    return events.selectExpr(*_aliased(TRANSACTIONS))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation")
    joined = table(spark, folder, "customer").join(nations, F.expr(HOME))
    return joined.selectExpr(*_aliased(CUSTOMERS))


def watchlist(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    """Entries as parsed from files: with nothing to rescue, and no file."""
    return table(spark, folder, "supplier", stream).selectExpr(
        *_aliased(WATCHLIST_ENTRIES),
        "cast(null as string) as _rescued_data",
        "cast(null as string) as file_path",
        "current_timestamp() as ingestion_ts",
    )


def messages(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    """Transactions as Kafka would deliver them: JSON, with key and value in binary.

    They come in a part for each core, as from a topic of as many partitions. A task reads a
    row group as a whole, so that a file of one would otherwise be written as JSON, parsed
    and checked by a single task, however large it is.
    """
    events = table(spark, folder, "events", stream)
    events = events.repartition(spark.sparkContext.defaultParallelism, "event_id")
    rows = _as_transactions(events)
    number = F.substring("transaction_id", 2, 20).cast("long")
    as_json = F.to_json(
        F.struct(*TRANSACTION.names), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    )
    return rows.select(
        F.col("transaction_id").cast("binary").alias("key"),
        as_json.cast("binary").alias("value"),
        F.lit("transactions").alias("topic"),
        (number % 8).cast("int").alias("partition"),
        number.alias("offset"),
        F.col("transaction_timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def _aliased(columns: dict[str, str]) -> list[str]:
    return [f"{expression} as {name}" for name, expression in columns.items()]
