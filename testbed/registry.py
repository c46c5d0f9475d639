"""Every registered query, on the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardinel import functions as cf
from cardinel.operators import (
    card_alerts,
    clean_customers,
    clean_watchlist,
    count_sliding,
    count_tumbling,
    expect_drop,
    expect_warn,
    limit_alerts,
    parse_transactions,
    rule_counts,
)
from cardinel.operators.alerts import alert_matches, match_cards
from cardinel.operators.quality import (
    CUSTOMER_DROP,
    TRANSACTION_DROP,
    TRANSACTION_WARN,
    Expectation,
)
from cardinel.operators.skew import hot_keys
from cardinel.plans import dashboard
from cardinel.plans import monitor as job
from cardinel.plans.notifications import (
    notification_counts,
    render_card_notifications,
    render_limit_notifications,
)
from cardinel.schemas import TRANSACTION, WATCHLIST
from cardinel.session import prepare, work_folder
from cardinel.sources import (
    envelope,
    export_entries,
    infer_schema,
    landed_mark,
    parse_watchlist,
    read_json_lines,
    read_landed,
    stream_json_lines,
)
from cardinel.streaming import (
    append_batches,
    append_joined,
    append_to_path,
    append_to_table,
    attach_outbox,
    create_layers,
    declare,
    finish,
    outbox_stats,
    read_outbox,
    rule_totals,
    table_properties,
)
from cardinel.streaming.batches import BATCH
from cardinel.streaming.folds import side_by_side
from cardinel.streaming.tables import LAYERS
from testbed import mapping

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    """Register under the function's name, with times as text in the result."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _plain(query(prepare(spark), folder))

    QUERIES[query.__name__] = run
    return query


def _plain(df: DataFrame) -> DataFrame:
    """Times as text, so that zoned and plain ones compare alike."""
    kinds = ("timestamp", "timestamp_ntz", "date")
    return df.select(
        *[
            F.col(name).cast("string").alias(name) if kind in kinds else F.col(name)
            for name, kind in df.dtypes
        ]
    )


# The tables the queries start from. Alerts are stamped with the transaction's
# time, so that their order does not depend on when a query ran.


def silver_transactions_table(spark: SparkSession, folder: str) -> DataFrame:
    return expect_drop(mapping.transactions(spark, folder), TRANSACTION_DROP)


def silver_transactions_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    messages = mapping.messages(spark, folder, stream=True)
    parsed = parse_transactions(envelope(messages))
    return expect_drop(
        expect_warn(parsed, TRANSACTION_WARN, "warn"), TRANSACTION_DROP, "drop"
    )


def silver_customers_table(spark: SparkSession, folder: str) -> DataFrame:
    return expect_drop(clean_customers(mapping.customers(spark, folder)), CUSTOMER_DROP)


def silver_watchlist_table(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    return clean_watchlist(mapping.watchlist(spark, folder, stream))


def limit_alerts_table(spark: SparkSession, folder: str) -> DataFrame:
    return limit_alerts(
        silver_transactions_table(spark, folder),
        silver_customers_table(spark, folder),
        now=F.col("transaction_timestamp"),
    )


def card_alerts_table(spark: SparkSession, folder: str) -> DataFrame:
    return card_alerts(
        silver_transactions_table(spark, folder),
        silver_watchlist_table(spark, folder),
        silver_customers_table(spark, folder),
        now=F.col("transaction_timestamp"),
    )


def limit_alerts_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    return limit_alerts(
        silver_transactions_of_stream(spark, folder),
        silver_customers_table(spark, folder),
        now=F.col("transaction_timestamp"),
    )


def stored(df: DataFrame, name: str, stateful: bool = False) -> DataFrame:
    """What a stream has written once it has taken in everything there is."""
    spark = df.sparkSession
    work = work_folder(spark, name)
    finish(append_to_path(df, f"{work}/data", f"{work}/checkpoint", stateful=stateful))
    return spark.read.schema(df.schema).parquet(f"{work}/data")


# Sources and cleaning.


@registered
def kafka_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """Message columns as text; the value is the event's own JSON text."""
    events = mapping.table(spark, folder, "events")
    messages = events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit("transactions").alias("topic"),
        (F.col("event_id") % 8).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    return envelope(messages, stamped=False)


@registered
def kafka_batch_table(spark: SparkSession, folder: str) -> DataFrame:
    """All messages there are, saved as a table and read as it stands."""
    work = work_folder(spark, "batch_table")
    layer = f"batch_{work.rsplit('-', 1)[1]}"
    create_layers(spark, [layer], work)
    envelope(mapping.messages(spark, folder), stamped=False).write.saveAsTable(f"{layer}.messages")
    saved = spark.read.table(f"{layer}.messages")
    fields = F.from_json("value", TRANSACTION)
    return _and_dropped(saved.withColumn("value", fields).select("*", "value.*").drop("value"), [layer])


@registered
def silver_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return silver_transactions_table(spark, folder)


@registered
def silver_transactions_from_json(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_transactions(envelope(mapping.messages(spark, folder)))
    return _untimed(expect_drop(parsed, TRANSACTION_DROP, "drop"))


@registered
def silver_transactions_stream(spark: SparkSession, folder: str) -> DataFrame:
    rows = silver_transactions_of_stream(spark, folder)
    return _untimed(stored(rows, "silver_transactions"))


@registered
def expectation_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rules = {**TRANSACTION_WARN, **TRANSACTION_DROP}
    return rule_counts(mapping.transactions(spark, folder), rules)


@registered
def expectation_metrics_customers(spark: SparkSession, folder: str) -> DataFrame:
    return rule_counts(clean_customers(mapping.customers(spark, folder)), CUSTOMER_DROP)


@registered
def expectation_metrics_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The counts of all batches of a stream, kept by the batches that write its rows."""
    work = work_folder(spark, "expectation_metrics")
    layer = f"checked_{work.rsplit('-', 1)[1]}"
    checked = Expectation("warn", TRANSACTION_WARN), Expectation("drop", TRANSACTION_DROP, drop=True)
    _in_batches(spark, folder, work, layer, expectations=checked, counts=f"{work}/rules")
    counts = rule_totals(spark, f"{work}/rules", "warn").union(
        rule_totals(spark, f"{work}/rules", "drop").filter("rule <> 'rows'")
    )
    names = ["rows", *TRANSACTION_WARN, *TRANSACTION_DROP]
    return _and_dropped(counts.groupBy().pivot("rule", names).agg(F.first("n")), [layer])


def _in_batches(spark: SparkSession, folder: str, work: str, layer: str, **more) -> str:
    """Transactions appended to a table from messages that came in eight files, two a batch."""
    arrived = mapping.messages(spark, folder)
    arrived.repartition(8, "offset").write.parquet(f"{work}/arrived")
    stream = spark.readStream.schema(arrived.schema).option("maxFilesPerTrigger", 2)
    create_layers(spark, [layer], f"{work}/tables")
    table = f"{layer}.transactions"
    rows = parse_transactions(envelope(arrived)).withColumn(BATCH, F.lit(""))
    declare(spark, table, rows.schema, "Transactions", "silver", partition_by=[BATCH])
    messages = stream.parquet(f"{work}/arrived")
    finish(append_batches(envelope(messages), parse_transactions, table, f"{work}/point", **more))
    return table


@registered
def silver_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _untimed(silver_customers_table(spark, folder))


@registered
def silver_watchlist(spark: SparkSession, folder: str) -> DataFrame:
    return _untimed(silver_watchlist_table(spark, folder)).drop("source_file")


@registered
def watchlist_json_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Entries landed as JSON files, picked up by a stream and cleaned."""
    work = work_folder(spark, "watchlist_json")
    _raw_watchlist(spark, folder).write.json(f"{work}/landed")
    bronze = parse_watchlist(stream_json_lines(spark, f"{work}/landed"))
    rows = stored(clean_watchlist(bronze), "watchlist_json")
    from_file = F.col("source_file").endswith(".json").alias("from_json_file")
    return _untimed(rows).select("*", from_file).drop("source_file")


@registered
def rescued_watchlist(spark: SparkSession, folder: str) -> DataFrame:
    """Fields the schema lacks, values of another type and broken lines, kept as text.

    Lines come one for a supplier, some cut off, and one array of two for each nation's.
    """
    work = work_folder(spark, "rescued_watchlist")
    parts = [
        """'"watchlist_id":"WL' || s_suppkey || '"'""",
        """'"score":' || case when s_acctbal < 0 then '"overdrawn"'
                            else cast(s_nationkey as string) end""",
        """case when s_nationkey > 12 then '"note":"' || s_name || '"' end""",
        """case when s_nationkey > 18 then '"nation":{"key":' || s_nationkey || '}' end""",
    ]
    suppliers = mapping.table(spark, folder, "supplier")
    document = suppliers.selectExpr(f"concat('{{', concat_ws(',', {', '.join(parts)}), '}}')")
    document.write.text(f"{work}/landed")
    suppliers.selectExpr(
        """case s_nationkey % 3 when 0 then concat('{"watchlist_id":"CUT', s_suppkey)
           when 1 then concat('line ', s_suppkey)
           else concat('[{"watchlist_id":"A', s_suppkey, '"},{"watchlist_id":"B', s_suppkey,
                       '","score":2.5}]') end"""
    ).write.mode("append").text(f"{work}/landed")
    schema = T.StructType().add("watchlist_id", "string").add("score", "double")
    return parse_watchlist(read_json_lines(spark, f"{work}/landed"), schema).drop(
        "file_path", "ingestion_ts"
    )


@registered
def inferred_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Rows parsed by a schema that was inferred, kept, and read back."""
    work = work_folder(spark, "inferred_schema")
    mapping.table(spark, folder, "supplier").write.json(f"{work}/landed")
    infer_schema(spark, f"{work}/landed", f"{work}/schema")
    kept = infer_schema(spark, f"{work}/landed", f"{work}/schema")
    bronze = parse_watchlist(stream_json_lines(spark, f"{work}/landed"), kept)
    return stored(bronze, "inferred_schema").drop("file_path", "ingestion_ts")


@registered
def landed_watchlist_mark(spark: SparkSession, folder: str) -> DataFrame:
    work = work_folder(spark, "landed_mark")
    _exportable(spark, folder).write.json(f"{work}/landed")
    return landed_mark(read_landed(spark, f"{work}/landed"))


@registered
def export_new_watchlist(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of a CSV file that are above the highest number landed.

    Landed are those up to the mean number; after the export all have landed
    once, and what is above the mean number is returned.
    """
    work = work_folder(spark, "export_new")
    entries = _exportable(spark, folder)
    number = cf.watchlist_number("watchlist_id")
    mean = entries.agg(F.avg(number)).scalar()
    entries.write.csv(f"{work}/source", header=True)
    entries.filter(number <= mean).write.json(f"{work}/landed")
    export_entries(spark, f"{work}/source", f"{work}/landed")
    landed = parse_watchlist(read_json_lines(spark, f"{work}/landed"))
    return landed.filter(number > mean).select(*WATCHLIST.names)


@registered
def table_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Declare a table in partitions, append a stream to it, stream it on into a second
    one, and read that one as it stands."""
    work = work_folder(spark, "round_trip")
    layer = f"trip_{work.rsplit('-', 1)[1]}"
    create_layers(spark, [layer], work)
    rows = mapping.transactions(spark, folder, stream=True)
    for name, source in (("first", None), ("second", "first")):
        if source:
            rows = spark.readStream.table(f"{layer}.{source}")
        table, parts = f"{layer}.{name}", ["payment_channel"]
        declare(
            spark, table, rows.schema, "Round trip", "silver", protected=True, partition_by=parts
        )
        point = f"{work}/checkpoints/{name}"
        finish(append_to_table(rows, table, point, partition_by=parts))
    quality = table_properties(spark, f"{layer}.second")["quality"]
    rows = spark.read.table(f"{layer}.second").withColumn("quality", F.lit(quality))
    return _and_dropped(rows, [layer])


@registered
def table_inspection(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and column names of a table."""
    rows = silver_transactions_table(spark, folder)
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(",".join(rows.columns)).alias("column_names"),
    )


# Alerts.


@registered
def limit_alerts_batch(spark: SparkSession, folder: str) -> DataFrame:
    return limit_alerts_table(spark, folder).drop("alert_timestamp")


@registered
def limit_alerts_stream(spark: SparkSession, folder: str) -> DataFrame:
    return stored(limit_alerts_of_stream(spark, folder), "limit_alerts").drop("alert_timestamp")


@registered
def card_alerts_batch(spark: SparkSession, folder: str) -> DataFrame:
    return card_alerts_table(spark, folder).drop("alert_timestamp")


@registered
def card_alerts_salted(spark: SparkSession, folder: str) -> DataFrame:
    """With every card spread over several parts; the alerts are the same."""
    return card_alerts(
        silver_transactions_table(spark, folder),
        silver_watchlist_table(spark, folder),
        silver_customers_table(spark, folder),
        salts=8,
    ).drop("alert_timestamp")


@registered
def card_alerts_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams joined in state, hot cards spread, and customers joined by a second query."""
    work = work_folder(spark, "card_matches")
    hot = hot_keys(mapping.transactions(spark, folder), "card_number", 64)
    matches = match_cards(
        silver_transactions_of_stream(spark, folder),
        silver_watchlist_table(spark, folder, stream=True),
        salts=16,
        hot=hot,
    )
    matched = append_to_path(
        matches, f"{work}/data", f"{work}/checkpoint", stateful=True, count_state=False
    )
    finish(matched)
    arrived = spark.readStream.schema(matches.schema).parquet(f"{work}/data")
    alerts = alert_matches(arrived, silver_customers_table(spark, folder))
    return stored(alerts, "card_alerts").drop("alert_timestamp")


@registered
def card_alerts_history(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams that come in several batches, joined by files of all earlier rows."""
    work = work_folder(spark, "card_history")
    layer = f"history_{work.rsplit('-', 1)[1]}"
    create_layers(spark, [layer], f"{work}/tables")
    sides = []
    for name, rows, key in (
        ("paid", silver_transactions_table(spark, folder), "transaction_id"),
        ("listed", silver_watchlist_table(spark, folder), "watchlist_id"),
    ):
        rows.repartition(4, key).write.parquet(f"{work}/{name}")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
        sides.append(stream.parquet(f"{work}/{name}"))
    table = f"{layer}.matches"
    rows = match_cards(*sides).withColumn(BATCH, F.lit(""))
    declare(spark, table, rows.schema, "Card matches", "gold", partition_by=[BATCH])
    keys = ("card_number", "entity_id")
    finish(append_joined(*sides, keys, match_cards, table, f"{work}/history", f"{work}/point"))
    matches = spark.read.table(table).drop(BATCH)
    alerts = alert_matches(matches, silver_customers_table(spark, folder))
    return _and_dropped(alerts.drop("alert_timestamp"), [layer])


# Windowed counts.


@registered
def window_tumbling_batch(spark: SparkSession, folder: str) -> DataFrame:
    return count_tumbling(silver_transactions_table(spark, folder))


@registered
def window_sliding_batch(spark: SparkSession, folder: str) -> DataFrame:
    return count_sliding(silver_transactions_table(spark, folder))


@registered
def window_tumbling_stream(spark: SparkSession, folder: str) -> DataFrame:
    rows = silver_transactions_of_stream(spark, folder)
    return stored(count_tumbling(rows), "window_tumbling", stateful=True)


@registered
def window_sliding_stream(spark: SparkSession, folder: str) -> DataFrame:
    rows = silver_transactions_of_stream(spark, folder)
    return stored(count_sliding(rows), "window_sliding", stateful=True)


# Notifications.


@registered
def limit_notifications(spark: SparkSession, folder: str) -> DataFrame:
    return render_limit_notifications(limit_alerts_table(spark, folder))


@registered
def card_notifications(spark: SparkSession, folder: str) -> DataFrame:
    return render_card_notifications(card_alerts_table(spark, folder))


@registered
def notification_stats(spark: SparkSession, folder: str) -> DataFrame:
    return notification_counts(render_card_notifications(card_alerts_table(spark, folder)))


@registered
def outbox_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of alerts rendered into the outbox, batch by batch."""
    return read_outbox(spark, _filled_outbox(spark, folder)).drop("query_id", "upstream")


@registered
def outbox_stream_stats(spark: SparkSession, folder: str) -> DataFrame:
    return outbox_stats(read_outbox(spark, _filled_outbox(spark, folder))).drop("query_id")


@registered
def display_values(spark: SparkSession, folder: str) -> DataFrame:
    """The values of a mail on their own: mask, badge colour, flag, money, time."""
    return card_alerts_table(spark, folder).select(
        "alert_id",
        cf.mask_card("card_number").alias("masked_card"),
        cf.risk_colour("risk_level").alias("risk_colour"),
        cf.yes_no("is_international").alias("abroad"),
        cf.money("amount").alias("money"),
        cf.shown("customer_email").alias("email"),
        cf.shown_time("transaction_timestamp").alias("paid_at"),
        cf.shown_time("watchlist_effective_from").alias("listed_from"),
    )


# Dashboard.


def _dashboard(name: str, table: Query, dataset: Callable[[DataFrame], DataFrame]) -> None:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return dataset(table(spark, folder))

    query.__name__ = name
    registered(query)


def _tumbling(spark: SparkSession, folder: str) -> DataFrame:
    return count_tumbling(silver_transactions_table(spark, folder))


for _name, _table in {
    "txn_by_merchant": silver_transactions_table,
    "txn_by_minute": _tumbling,
    "fraud_card_alerts_count": card_alerts_table,
    "fraud_by_reason": card_alerts_table,
    "intl_vs_domestic": silver_transactions_table,
    "top_cities": silver_transactions_table,
    "fraud_by_risk": card_alerts_table,
    "limit_exceeded_count": limit_alerts_table,
    "recent_limit_alerts": limit_alerts_table,
    "recent_fraud_alerts": card_alerts_table,
    "total_transactions": silver_transactions_table,
    "txn_by_channel": silver_transactions_table,
    "total_volume": silver_transactions_table,
}.items():
    _dashboard(_name, _table, getattr(dashboard, _name))

for _name, _table in {
    "txn_by_merchant": silver_transactions_table,
    "txn_by_channel": silver_transactions_table,
    "fraud_by_risk": card_alerts_table,
    "fraud_by_reason": card_alerts_table,
    "intl_vs_domestic": silver_transactions_table,
}.items():
    _dashboard(
        f"widget_{_name}",
        _table,
        lambda df, dataset=getattr(dashboard, _name): dashboard.widget_totals(dataset(df)),
    )


@registered
def dashboard_overview(spark: SparkSession, folder: str) -> DataFrame:
    """The counts behind all transaction reports at once."""
    overview = dashboard.transaction_overview(silver_transactions_table(spark, folder))
    return overview.withColumn("amount", F.round("amount", 2))


@registered
def dashboard_datasets(spark: SparkSession, folder: str) -> DataFrame:
    """All reports as text rows under their names, those of transactions from one scan."""
    datasets = dashboard.refresh(
        silver_transactions_table(spark, folder),
        _tumbling(spark, folder),
        limit_alerts_table(spark, folder),
        card_alerts_table(spark, folder),
        work_folder(spark, "dashboard"),
    )
    return _report_rows(datasets)


@registered
def dashboard_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """All reports from the summaries that the batches of a stream have kept."""
    work = work_folder(spark, "dashboard_incremental")
    layer = f"summed_{work.rsplit('-', 1)[1]}"
    stamp = F.col("transaction_timestamp")
    people = silver_customers_table(spark, folder)
    entries = silver_watchlist_table(spark, folder)

    def summaries(rows: DataFrame, writer: str, number: int) -> None:
        parts = {
            "transactions": (dashboard.OF_TRANSACTIONS, rows),
            "limit": (dashboard.OF_LIMIT_ALERTS, limit_alerts(rows, people, now=stamp)),
            "card": (dashboard.OF_CARD_ALERTS, card_alerts(rows, entries, people, now=stamp)),
        }
        side_by_side(
            spark,
            *[
                partial(fold.add, part, f"{work}/dashboard/{name}", writer, number)
                for folds, part in parts.values()
                for name, fold in folds.items()
            ],
        )

    checked = [Expectation("drop", TRANSACTION_DROP, drop=True)]
    more = {"expectations": checked, "counts": f"{work}/rules", "steps": [summaries]}
    table = _in_batches(spark, folder, work, layer, **more)
    minutes = count_tumbling(spark.read.table(table))
    return _and_dropped(_report_rows(dashboard.summarised(spark, f"{work}/dashboard", minutes)), [layer])


def _report_rows(datasets: dict[str, DataFrame]) -> DataFrame:
    """All reports as text rows under their names; of the long rows, what names the alert."""
    alert = ["alert_id", "alert_timestamp", "customer_name", "currency", "merchant_name"]
    columns = {name: df.columns for name, df in datasets.items()}
    columns |= {"recent_limit_alerts": alert, "recent_fraud_alerts": alert}
    rows = [
        datasets[name].select(
            F.lit(name).alias("dataset"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in kept]).alias("content"),
        )
        for name, kept in columns.items()
    ]
    return reduce(DataFrame.unionAll, rows)


# The whole job. Of each table, what does not hold the time of the run or fractions.

JOB_CONTENTS = {
    job.BRONZE_TRANSACTIONS: ["key", "topic", "partition", "offset"],
    job.BRONZE_WATCHLIST: ["watchlist_id", "entity_id", "effective_from", "status"],
    job.SILVER_TRANSACTIONS: [
        "transaction_id", "customer_id", "card_number", "merchant_name", "currency", "city",
        "transaction_timestamp", "is_international", "status",
    ],
    job.SILVER_WATCHLIST: ["watchlist_id", "entity_id", "risk_level", "effective_from"],
    job.SILVER_CUSTOMERS: ["customer_id", "card_number", "email", "account_open_date"],
    job.LIMIT_ALERTS: ["alert_id", "customer_id", "customer_name", "customer_email", "currency"],
    job.CARD_MATCHES: ["transaction_id", "card_number", "watchlist_id", "risk_level"],
    job.CARD_ALERTS: ["alert_id", "customer_id", "customer_name", "customer_email", "risk_level"],
    job.TUMBLING_COUNTS: ["window_start", "window_end", "transaction_count"],
    job.SLIDING_COUNTS: ["window_start", "window_end", "transaction_count"],
    f"outbox.{job.LIMIT_ALERTS}": ["alert_id", "recipient", "subject", "body", "deliverable"],
    f"outbox.{job.CARD_ALERTS}": ["alert_id", "recipient", "subject", "deliverable"],
}


@registered
def monitor_run_once(spark: SparkSession, folder: str) -> DataFrame:
    """Contents of every table and outbox after one run over all messages and files."""
    work = work_folder(spark, "monitor")
    monitor = job.Monitor(
        spark,
        folder=work,
        messages=lambda: mapping.messages(spark, folder, stream=True),
        watchlist_folder=f"{work}/landed",
        own_layers=True,
        prefix=f"run_{work.rsplit('-', 1)[1]}_",
    )
    _raw_watchlist(spark, folder).write.json(f"{work}/landed")
    monitor.set_up()
    customers = monitor.table(job.BRONZE_CUSTOMERS)
    mapping.customers(spark, folder).write.insertInto(customers)
    monitor.run_once()
    names = [table.name for stage in monitor.stages() for table in stage]
    rows = {name: spark.read.table(monitor.table(name)) for name in names}
    rows |= {
        f"outbox.{name}": read_outbox(spark, monitor.outbox(name))
        for name in (job.LIMIT_ALERTS, job.CARD_ALERTS)
    }
    contents = [
        df.select(
            F.lit(name).alias("table_name"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in JOB_CONTENTS[name]]).alias(
                "content"
            ),
        )
        for name, df in rows.items()
    ]
    layers = [monitor.table(layer) for layer in LAYERS]
    return _and_dropped(reduce(DataFrame.unionAll, contents), layers)


def _and_dropped(df: DataFrame, layers: list[str]) -> DataFrame:
    """The rows from a folder of their own; the databases they came from are dropped."""
    spark, work = df.sparkSession, work_folder(df.sparkSession, "result")
    df.write.parquet(work)
    for layer in layers:
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")
    return spark.read.schema(df.schema).parquet(work)


def _untimed(df: DataFrame) -> DataFrame:
    """Without the columns that hold the time of the run."""
    return df.drop("bronze_ingestion_timestamp", "silver_ingestion_timestamp", "ingestion_ts")


def _raw_watchlist(spark: SparkSession, folder: str) -> DataFrame:
    return mapping.watchlist(spark, folder).select(*WATCHLIST.names)


def _exportable(spark: SparkSession, folder: str) -> DataFrame:
    """Entries with ids as the source file has them."""
    return _raw_watchlist(spark, folder).withColumn("watchlist_id", F.upper("watchlist_id"))


def _filled_outbox(spark: SparkSession, folder: str) -> str:
    work = work_folder(spark, "outbox")
    alerts = limit_alerts_of_stream(spark, folder)
    finish(
        attach_outbox(alerts, render_limit_notifications, f"{work}/outbox", f"{work}/checkpoint")
    )
    return f"{work}/outbox"
