"""The dashboard's queries over the transaction and alert tables.

They come in three ways: each by itself, all transaction reports from one scan
(`refresh`), or from summaries that every batch of the tables keeps up to date
(`summarised`), which reads as many rows as there are labels and reported alerts. Reports that keep only the first rows break ties by the label or alert id, so
that they give the same rows every time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardinel.streaming.folds import Fold, first_rows, sums

# Rows kept by the top reports and the recent alerts, the unit of
# the volume, and the labels of the two scopes.
TOP = 10
RECENT = 50
MILLION = 1_000_000
INTERNATIONAL = "International"
DOMESTIC = "Domestic"


# Labels of the transaction reports that `transaction_overview` counts together.
LABELS = ("merchant_category", "city", "payment_channel", "is_international")


def txn_by_merchant(transactions: DataFrame) -> DataFrame:
    return _by(transactions, "merchant_category", "transaction_count").limit(TOP)


def top_cities(transactions: DataFrame) -> DataFrame:
    return _by(transactions, "city", "transaction_count").limit(TOP)


def txn_by_channel(transactions: DataFrame) -> DataFrame:
    return _by(transactions, "payment_channel", "transaction_count")


def fraud_by_reason(card_alerts: DataFrame) -> DataFrame:
    return _by(card_alerts, "reason_code", "alert_count")


def fraud_by_risk(card_alerts: DataFrame) -> DataFrame:
    return _by(card_alerts, "risk_level", "alert_count")


def intl_vs_domestic(transactions: DataFrame) -> DataFrame:
    """Counted by the flag itself: rows without one are a second 'Domestic' group."""
    counts = transactions.groupBy("is_international").agg(
        F.count(F.lit(1)).alias("transaction_count")
    )
    return _scoped(counts)


def txn_by_minute(tumbling_counts: DataFrame) -> DataFrame:
    return tumbling_counts.select("window_start", "transaction_count").orderBy("window_start")


def total_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.agg(F.count(F.lit(1)).alias("total_transactions"))


def fraud_card_alerts_count(card_alerts: DataFrame) -> DataFrame:
    return card_alerts.agg(F.count(F.lit(1)).alias("fraud_card_alerts"))


def limit_exceeded_count(limit_alerts: DataFrame) -> DataFrame:
    return limit_alerts.agg(F.count(F.lit(1)).alias("limit_exceeded_alerts"))


def total_volume(transactions: DataFrame) -> DataFrame:
    """Sum of the amounts in millions; NULL if there are none."""
    return transactions.agg(_millions(F.sum("amount")).alias("total_volume_m"))


def recent_limit_alerts(limit_alerts: DataFrame) -> DataFrame:
    return _latest(limit_alerts).select(
        "alert_id",
        "alert_timestamp",
        "customer_name",
        "customer_email",
        F.round("transaction_amount", 2).alias("transaction_amount"),
        "transaction_limit",
        "currency",
        "merchant_name",
        "merchant_category",
        "payment_channel",
        "city",
        "status",
    )


def recent_fraud_alerts(card_alerts: DataFrame) -> DataFrame:
    """With the full card number; `mask_card` hides it."""
    return _latest(card_alerts).select(
        "alert_id",
        "alert_timestamp",
        "customer_name",
        "customer_email",
        "card_number",
        F.round("amount", 2).alias("amount"),
        "currency",
        "merchant_name",
        "merchant_category",
        "transaction_city",
        "risk_level",
        "reason_code",
        "watch_type",
    )


def widget_totals(dataset: DataFrame) -> DataFrame:
    """A chart over a dataset of label and count: the counts added up per label."""
    label, count = dataset.columns
    return dataset.groupBy(label).agg(F.sum(count).alias(f"sum_{count}"))


def transaction_overview(transactions: DataFrame) -> DataFrame:
    """The counts behind all transaction reports, and the volume, from one scan.

    Each label is a grouping set of its own, so the result has as many rows as
    there are labels, not as there are combinations of them.
    """
    sets = [[F.col(label)] for label in LABELS] + [[]]
    return transactions.groupingSets(sets, *LABELS).agg(
        F.grouping_id().alias("level"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("amount").alias("amount"),
    )


def datasets(
    transactions: DataFrame,
    tumbling_counts: DataFrame,
    limit_alerts: DataFrame,
    card_alerts: DataFrame,
) -> dict[str, DataFrame]:
    """All datasets of the dashboard, none of them computed yet.

    The six transaction reports share one scan; `refresh` writes its few rows to a
    folder, from which they can all be read.
    """
    return _datasets(
        transaction_overview(transactions), tumbling_counts, limit_alerts, card_alerts
    )


def refresh(
    transactions: DataFrame,
    tumbling_counts: DataFrame,
    limit_alerts: DataFrame,
    card_alerts: DataFrame,
    folder: str,
) -> dict[str, DataFrame]:
    """All datasets, with the transactions read now and once; replaces the folder."""
    overview = transaction_overview(transactions)
    overview.write.mode("overwrite").parquet(folder)
    kept = transactions.sparkSession.read.schema(overview.schema).parquet(folder)
    return _datasets(kept, tumbling_counts, limit_alerts, card_alerts)


# Labels of the card alert reports, counted together.
ALERT_LABELS = ("reason_code", "risk_level")


def alert_overview(card_alerts: DataFrame) -> DataFrame:
    """The counts behind all card alert reports, from one scan."""
    sets = [[F.col(label)] for label in ALERT_LABELS] + [[]]
    return card_alerts.groupingSets(sets, *ALERT_LABELS).agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).alias("alert_count")
    )


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


TRANSACTIONS = Fold(
    _text(*LABELS[:3])
    .add("is_international", "boolean")
    .add("level", "long")
    .add("transaction_count", "long")
    .add("amount", "double"),
    transaction_overview,
    sums([*LABELS, "level"], ["transaction_count", "amount"]),
)
CARD_ALERT_COUNTS = Fold(
    _text(*ALERT_LABELS).add("level", "long").add("alert_count", "long"),
    alert_overview,
    sums([*ALERT_LABELS, "level"], ["alert_count"]),
)
LIMIT_ALERT_COUNT = Fold(
    T.StructType().add("limit_exceeded_alerts", "long"),
    limit_exceeded_count,
    lambda parts: parts.agg(
        F.coalesce(F.sum("limit_exceeded_alerts"), F.lit(0)).alias("limit_exceeded_alerts")
    ),
)


def _kept_latest(schema: T.StructType, report) -> Fold:
    """The latest alerts; those of one time and id in the order of their other columns."""
    order = {"alert_timestamp": False, "alert_id": True} | dict.fromkeys(schema.names[2:], True)
    return Fold(schema, report, first_rows(order, RECENT))


RECENT_LIMIT_ALERTS = _kept_latest(
    T.StructType()
    .add("alert_id", "string")
    .add("alert_timestamp", "timestamp")
    .add("customer_name", "string")
    .add("customer_email", "string")
    .add("transaction_amount", "double")
    .add("transaction_limit", "double")
    .add("currency", "string")
    .add("merchant_name", "string")
    .add("merchant_category", "string")
    .add("payment_channel", "string")
    .add("city", "string")
    .add("status", "string"),
    recent_limit_alerts,
)
RECENT_CARD_ALERTS = _kept_latest(
    T.StructType()
    .add("alert_id", "string")
    .add("alert_timestamp", "timestamp")
    .add("customer_name", "string")
    .add("customer_email", "string")
    .add("card_number", "string")
    .add("amount", "double")
    .add("currency", "string")
    .add("merchant_name", "string")
    .add("merchant_category", "string")
    .add("transaction_city", "string")
    .add("risk_level", "string")
    .add("reason_code", "string")
    .add("watch_type", "string"),
    recent_fraud_alerts,
)

# What the batches of each table keep up to date.
OF_TRANSACTIONS = {"transactions": TRANSACTIONS}
OF_LIMIT_ALERTS = {"limit_alert_count": LIMIT_ALERT_COUNT, "recent_limit_alerts": RECENT_LIMIT_ALERTS}
OF_CARD_ALERTS = {"card_alert_counts": CARD_ALERT_COUNTS, "recent_card_alerts": RECENT_CARD_ALERTS}


def summarised(
    spark: SparkSession, folder: str, tumbling_counts: DataFrame
) -> dict[str, DataFrame]:
    """All datasets from the summaries in the folder, under the names of the folds."""

    def read(folds: dict[str, Fold], name: str) -> DataFrame:
        return folds[name].read(spark, f"{folder}/{name}")

    alerts = read(OF_CARD_ALERTS, "card_alert_counts")

    def alert_counts(label: str) -> DataFrame:
        return _ranked(_level(alerts, [label], ALERT_LABELS).select(label, "alert_count"), label, "alert_count")

    total = _level(alerts, [], ALERT_LABELS)
    recent_limit = read(OF_LIMIT_ALERTS, "recent_limit_alerts")
    recent_card = read(OF_CARD_ALERTS, "recent_card_alerts")
    return _transaction_datasets(read(OF_TRANSACTIONS, "transactions")) | {
        "txn_by_minute": txn_by_minute(tumbling_counts),
        "fraud_card_alerts_count": total.agg(
            F.coalesce(F.sum("alert_count"), F.lit(0)).alias("fraud_card_alerts")
        ),
        "fraud_by_reason": alert_counts("reason_code"),
        "fraud_by_risk": alert_counts("risk_level"),
        "limit_exceeded_count": read(OF_LIMIT_ALERTS, "limit_alert_count"),
        "recent_limit_alerts": _latest(recent_limit),
        "recent_fraud_alerts": _latest(recent_card),
    }


def _datasets(
    overview: DataFrame,
    tumbling_counts: DataFrame,
    limit_alerts: DataFrame,
    card_alerts: DataFrame,
) -> dict[str, DataFrame]:
    return _transaction_datasets(overview) | {
        "txn_by_minute": txn_by_minute(tumbling_counts),
        "fraud_card_alerts_count": fraud_card_alerts_count(card_alerts),
        "fraud_by_reason": fraud_by_reason(card_alerts),
        "fraud_by_risk": fraud_by_risk(card_alerts),
        "limit_exceeded_count": limit_exceeded_count(limit_alerts),
        "recent_limit_alerts": recent_limit_alerts(limit_alerts),
        "recent_fraud_alerts": recent_fraud_alerts(card_alerts),
    }


def _transaction_datasets(overview: DataFrame) -> dict[str, DataFrame]:
    def counts(label: str) -> DataFrame:
        return _level(overview, [label]).select(label, "transaction_count")

    total = _level(overview, [])
    return {
        "txn_by_merchant": _ranked(
            counts("merchant_category"), "merchant_category", "transaction_count"
        ).limit(TOP),
        "intl_vs_domestic": _scoped(counts("is_international")),
        "top_cities": _ranked(counts("city"), "city", "transaction_count").limit(TOP),
        "total_transactions": total.agg(
            F.coalesce(F.sum("transaction_count"), F.lit(0)).alias("total_transactions")
        ),
        "txn_by_channel": _ranked(
            counts("payment_channel"), "payment_channel", "transaction_count"
        ),
        "total_volume": total.agg(_millions(F.sum("amount")).alias("total_volume_m")),
    }


def _level(overview: DataFrame, kept: list[str], labels: tuple[str, ...] = LABELS) -> DataFrame:
    """Rows of one grouping set: the grouping id has a bit for each absent label."""
    bits = ["0" if label in kept else "1" for label in labels]
    return overview.filter(F.col("level") == int("".join(bits), 2))


def _by(df: DataFrame, label: str, count: str) -> DataFrame:
    return _ranked(df.groupBy(label).agg(F.count(F.lit(1)).alias(count)), label, count)


def _ranked(counts: DataFrame, label: str, count: str) -> DataFrame:
    return counts.orderBy(F.desc(count), F.asc(label))


def _scoped(counts: DataFrame) -> DataFrame:
    scope = F.when(F.col("is_international"), INTERNATIONAL).otherwise(DOMESTIC)
    return counts.select(scope.alias("transaction_scope"), "transaction_count")


def _millions(amount: Column) -> Column:
    return F.round(amount / MILLION, 2)


def _latest(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(F.desc("alert_timestamp"), F.asc("alert_id")).limit(RECENT)
