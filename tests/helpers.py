"""Small hand-written inputs."""

import datetime as dt
import os

from cardinel.schemas import CUSTOMER, TRANSACTION, WATCHLIST

UTC = dt.timezone.utc


def at(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


def _rows(spark, schema, defaults, rows):
    filled = [{**defaults, **row} for row in rows]
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in filled], schema)


def transactions(spark, *rows):
    defaults = {
        "transaction_id": "T1",
        "customer_id": "C1",
        "card_number": "4111222233334444",
        "merchant_id": "M1",
        "merchant_name": "Shop",
        "merchant_category": "food",
        "amount": 10.0,
        "currency": "USD",
        "city": "Here",
        "country": "There",
        "transaction_timestamp": at("2024-01-01 00:00:30"),
        "status": "APPROVED",
    }
    return _rows(spark, TRANSACTION, defaults, rows)


def customers(spark, *rows):
    defaults = {
        "customer_id": "C1",
        "first_name": "Ann",
        "last_name": "Lee",
        "email": "ann@example.com",
        "transaction_limit": 5.0,
    }
    return _rows(spark, CUSTOMER, defaults, rows)


def raw_watchlist(spark, *rows):
    defaults = {
        "watchlist_id": "WL000001",
        "watch_type": "CARD",
        "entity_id": "4111222233334444",
        "effective_from": "01-Jan-2023 00:00:00",
        "risk_level": "high",
        "reason_code": "STOLEN",
        "status": "ACTIVE",
    }
    return _rows(spark, WATCHLIST, defaults, rows)


def watchlist(spark, *rows):
    """Entries as they are after cleaning."""
    from pyspark.sql import functions as F

    from cardinel.operators import clean_watchlist

    raw = raw_watchlist(spark, *rows)
    for name in ("_rescued_data", "file_path"):
        raw = raw.withColumn(name, F.lit(None).cast("string"))
    return clean_watchlist(raw.withColumn("ingestion_ts", F.current_timestamp()))


class Feed:
    """A folder of parquet files, read as a stream."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema = spark, str(folder), schema
        os.makedirs(folder, exist_ok=True)

    def add(self, df):
        df.coalesce(1).write.mode("append").parquet(self.folder)
        return self

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.folder)
