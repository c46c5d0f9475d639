"""The whole job: messages and files in, tables, alerts and notifications out.

    messages ─► bronze.transactions ─► silver.transactions ─► window counts
                                              │ │
                silver.customers ───────────► │ └─► gold.transaction_alerts ─► outbox
    files ─► bronze.watchlist ─► silver.watchlist ─► gold.card_matches
                                                        └─► gold.fraud_card_alerts ─► outbox

Card matching joins each batch of transactions and entries with all earlier ones, which
are kept as files by card; `match_by="state"` keeps them in the state of a stream-stream
join instead. Limit alerts and card alerts join customers as they are when a micro-batch
runs; adaptive execution plans all these joins by the real sizes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import types as T

from cardinel.operators.alerts import alert_matches, limit_alerts, match_cards
from cardinel.operators.cleaning import clean_customers, clean_watchlist, parse_transactions
from cardinel.operators.quality import (
    CUSTOMER_DROP,
    TRANSACTION_DROP,
    TRANSACTION_WARN,
    Expectation,
)
from cardinel.operators.windows import count_sliding, count_tumbling, missed
from cardinel.plans import dashboard
from cardinel.plans.notifications import render_card_notifications, render_limit_notifications
from cardinel.operators.skew import hot_keys
from cardinel.schemas import CUSTOMER, WATCHLIST
from cardinel.session import prepare
from cardinel.sources import envelope, parse_watchlist, stream_json_lines
from cardinel.sources.versions import SchemaLog, add_columns, by_version, inferred
from cardinel.streaming.batches import BATCH, append_batches, rule_totals
from cardinel.streaming.folds import Fold
from cardinel.streaming.history import append_joined
from cardinel.streaming.outbox import attach_outbox
from cardinel.streaming.progress import ProgressKeeper, kept_late_rows, read_reports
from cardinel.streaming.runner import (
    CATCH_UP,
    PARTITIONS,
    append_to_table,
    finish,
    kept_state,
)
from cardinel.streaming.tables import LAYERS, create_layers, declare

# Parts that the transactions of a hot card are spread over in match state.
SALTS = 16

BRONZE_CUSTOMERS = "bronze.customers"
BRONZE_TRANSACTIONS = "bronze.transactions"
BRONZE_WATCHLIST = "bronze.watchlist"
SILVER_TRANSACTIONS = "silver.transactions"
SILVER_WATCHLIST = "silver.watchlist"
SILVER_CUSTOMERS = "silver.customers"
LIMIT_ALERTS = "gold.transaction_alerts"
CARD_MATCHES = "gold.card_matches"
CARD_ALERTS = "gold.fraud_card_alerts"
TUMBLING_COUNTS = "gold.transaction_count_by_minute_tumbling_window"
SLIDING_COUNTS = "gold.transaction_count_by_minute_sliding_window"


@dataclass(frozen=True)
class StreamTable:
    """A table fed by one stream, and what the stream is.

    With `enrich` each micro-batch is transformed with tables as they are then, checked by
    the `expectations`, and followed by the `folds` that keep summaries of it. With
    `joined` it has the card matches of two streams.
    """

    name: str
    comment: str
    build: Callable[[], DataFrame]
    protected: bool = False
    stateful: bool = False
    enrich: Callable[[DataFrame], DataFrame] | None = None
    expectations: tuple[Expectation, ...] = ()
    folds: Mapping[str, Fold] = field(default_factory=dict)
    joined: tuple[Callable[[], DataFrame], Callable[[], DataFrame]] | None = None

    @property
    def in_batches(self) -> bool:
        return self.enrich is not None or self.joined is not None

    @property
    def quality(self) -> str:
        return self.name.split(".")[0]


@dataclass(frozen=True)
class Monitor:
    """Where a job reads and keeps its things.

    `folder` must be one all executors can reach; it gets the checkpoints, the
    outboxes and, if `own_layers`, the tables. `messages` gives the Kafka stream.
    Customer records are appended to `bronze.customers` by their own loader.
    `prefix` goes before every layer, to keep several jobs in one catalog apart.
    `match_by` says how cards are matched: by `history` (files, no state, no entry is
    late) or by `state`. `salts` are those of `match_cards` in the latter case, and
    `partitions` the state partitions; both hold for as long as the checkpoints live. The
    cards that are hot when matching by state begins are spread over the salts. With `infer`, fields that the watchlist's files have beyond the
    fixed ones become columns of the bronze table, from the batch on that brings them; the
    versions of its schema are kept, and `watchlist_entries` reads all rows by the last.
    `table_format` is that of all tables. Rule counts and the dashboard's summaries are kept
    by the batches that write the rows they are of.
    `limits` bounds the micro-batches of every stream that reads files or tables
    (`maxFilesPerTrigger`, `maxBytesPerTrigger`), so that a long backlog is worked
    off in steps; the messages are bounded by their own source.
    """

    spark: SparkSession
    folder: str
    messages: Callable[[], DataFrame]
    watchlist_folder: str
    notify: bool = True
    own_layers: bool = False
    prefix: str = ""
    match_by: str = "history"
    salts: int | None = None
    partitions: int | None = None
    infer: bool = False
    table_format: str = "parquet"
    limits: Mapping[str, str] = field(default_factory=dict)
    _keepers: list[ProgressKeeper] = field(default_factory=list, repr=False, compare=False)

    def set_up(self) -> None:
        """Create the layers and tables that are missing."""
        prepare(self.spark)
        create_layers(
            self.spark,
            [self.prefix + layer for layer in LAYERS],
            f"{self.folder}/tables" if self.own_layers else None,
        )
        declare(
            self.spark,
            self.table(BRONZE_CUSTOMERS),
            CUSTOMER,
            "Customer records as delivered",
            "bronze",
            table_format=self.table_format,
        )
        for stage in self.stages():
            for table in stage:
                if self.spark.catalog.tableExists(self.table(table.name)):
                    continue
                rows = table.build()
                if table.enrich:
                    rows = table.enrich(rows)
                if table.in_batches:
                    rows = rows.withColumn(BATCH, F.lit(""))
                declare(
                    self.spark,
                    self.table(table.name),
                    rows.schema,
                    table.comment,
                    table.quality,
                    table.protected,
                    table_format=self.table_format,
                    partition_by=[BATCH] if table.in_batches else [],
                )

    def run_once(self) -> list[StreamingQuery]:
        """Take in everything that has arrived, table by table, then stop."""
        self.set_up()
        keeper = self._keeper()
        done = []
        for stage in self.stages():
            queries = [self._start(table, CATCH_UP) for table in stage]
            finish(*queries)
            done += queries
        queries = self._start_outboxes(CATCH_UP)
        finish(*queries)
        keeper.stop(*done, *queries)
        return done + queries

    def start(self, trigger: Mapping[str, object]) -> list[StreamingQuery]:
        """Take in what is there, then start all streams side by side and leave them running.

        What has arrived before is thus worked off table by table, customers before
        alerts, and readers start on tables that their writers have committed to.
        """
        self.run_once()
        self._keepers.append(self._keeper())
        queries = [self._start(table, trigger) for stage in self.stages() for table in stage]
        return queries + self._start_outboxes(trigger)

    def stop(self, queries: list[StreamingQuery]) -> None:
        """Stop what `start` started."""
        for query in queries:
            query.stop()
        while self._keepers:
            self._keepers.pop().stop(*queries)

    def late_rows(self) -> DataFrame:
        """Rows that each query has dropped as late, for queries that have dropped any."""
        return kept_late_rows(read_reports(self.spark, f"{self.folder}/late"))

    def missed_transactions(self) -> DataFrame:
        """Closed minutes that lack late transactions, and how many."""
        return missed(self._snapshot(SILVER_TRANSACTIONS), self._snapshot(TUMBLING_COUNTS))

    def _keeper(self) -> ProgressKeeper:
        return ProgressKeeper(self.spark, f"{self.folder}/late", only_late=True).start()

    def rule_counts(self, metric: str) -> DataFrame:
        """Rows and violations of all batches ever written, as `rule` and `n`."""
        table = next(
            table.name
            for stage in self.stages()
            for table in stage
            if any(e.metric == metric for e in table.expectations)
        )
        return rule_totals(self.spark, self.counts(table), metric)

    def dashboard(self) -> dict[str, DataFrame]:
        """The dashboard's datasets by name, from the summaries that the batches keep.

        No transaction or alert is read again, however many there are.
        """
        return dashboard.summarised(
            self.spark, f"{self.folder}/dashboard", self._snapshot(TUMBLING_COUNTS)
        )

    def table(self, name: str) -> str:
        """The name in the catalog."""
        return self.prefix + name

    def counts(self, table: str) -> str:
        return f"{self.folder}/rules/{table}"

    def checkpoint(self, name: str) -> str:
        return f"{self.folder}/checkpoints/{name}"

    def outbox(self, table: str) -> str:
        return f"{self.folder}/outbox/{table}"

    def stages(self) -> list[list[StreamTable]]:
        """The tables; each stage reads only earlier ones."""
        return [
            [
                StreamTable(
                    BRONZE_TRANSACTIONS,
                    "Transaction messages as delivered",
                    lambda: envelope(self.messages()),
                    protected=True,
                ),
                StreamTable(
                    BRONZE_WATCHLIST,
                    "Watchlist entries as delivered",
                    self._lines if self.infer else lambda: parse_watchlist(self._lines()),
                    protected=True,
                    enrich=self._followed if self.infer else None,
                ),
            ],
            [
                StreamTable(
                    SILVER_TRANSACTIONS,
                    "Typed and checked transactions",
                    lambda: self._stream(BRONZE_TRANSACTIONS),
                    enrich=parse_transactions,
                    expectations=(
                        Expectation("transactions_warn", TRANSACTION_WARN),
                        Expectation("transactions_drop", TRANSACTION_DROP, drop=True),
                    ),
                    folds=dashboard.OF_TRANSACTIONS,
                ),
                StreamTable(
                    SILVER_WATCHLIST,
                    "Normalised watchlist entries",
                    lambda: clean_watchlist(self._stream(BRONZE_WATCHLIST)),
                    protected=True,
                ),
                StreamTable(
                    SILVER_CUSTOMERS,
                    "Checked customers",
                    lambda: self._stream(BRONZE_CUSTOMERS),
                    protected=True,
                    enrich=clean_customers,
                    expectations=(Expectation("customers_drop", CUSTOMER_DROP, drop=True),),
                ),
            ],
            [
                StreamTable(
                    LIMIT_ALERTS,
                    "Transactions above their customer's limit",
                    lambda: self._stream(SILVER_TRANSACTIONS),
                    enrich=lambda batch: limit_alerts(batch, self._customers_now(batch)),
                    folds=dashboard.OF_LIMIT_ALERTS,
                ),
                StreamTable(
                    CARD_MATCHES,
                    "Transactions with a card on the watchlist",
                    self._matches,
                    stateful=self.match_by == "state",
                    joined=None if self.match_by == "state" else (self._payments, self._entries),
                ),
                StreamTable(
                    TUMBLING_COUNTS,
                    "Transactions per minute",
                    lambda: count_tumbling(self._stream(SILVER_TRANSACTIONS)),
                    stateful=True,
                ),
                StreamTable(
                    SLIDING_COUNTS,
                    "Transactions of the last five minutes, every minute",
                    lambda: count_sliding(self._stream(SILVER_TRANSACTIONS)),
                    stateful=True,
                ),
            ],
            [
                StreamTable(
                    CARD_ALERTS,
                    "Card matches with their customer",
                    lambda: self._stream(CARD_MATCHES),
                    enrich=lambda batch: alert_matches(batch, self._customers_now(batch)),
                    folds=dashboard.OF_CARD_ALERTS,
                ),
            ],
        ]

    def _lines(self) -> DataFrame:
        return stream_json_lines(self.spark, self.watchlist_folder, **self.limits)

    def _followed(self, lines: DataFrame) -> DataFrame:
        """Entries of a batch with the columns that the table has by then.

        Fields that are new to the feed are found in the batch's own files.
        """
        spark, table = lines.sparkSession, self.table(BRONZE_WATCHLIST)
        if lines.isStreaming or not spark.catalog.tableExists(table):
            return parse_watchlist(lines)
        paths = [row[0] for row in lines.select("file_path").distinct().collect()]
        own = WATCHLIST
        if paths:
            found = inferred(spark, paths)
            more = T.StructType([f for f in found if f.name not in WATCHLIST.names])
            log = SchemaLog(spark, f"{self.folder}/schema/watchlist")
            more = add_columns(spark, table, log.follow(more, paths[0]))
            own = T.StructType([*WATCHLIST, *more])
        return parse_watchlist(lines, own)

    def watchlist_entries(self) -> DataFrame:
        """Entries as delivered, all by the last version of the feed's schema."""
        log = SchemaLog(self.spark, f"{self.folder}/schema/watchlist")
        return by_version(self._snapshot(BRONZE_WATCHLIST), T.StructType([*WATCHLIST, *log.latest()]))

    def _customers_now(self, batch: DataFrame) -> DataFrame:
        """Customers as their table stands, in the session of the batch."""
        spark, name = batch.sparkSession, self.table(SILVER_CUSTOMERS)
        spark.catalog.refreshTable(name)
        return spark.read.table(name)

    def _payments(self) -> DataFrame:
        return self._stream(SILVER_TRANSACTIONS).drop(BATCH)

    def _entries(self) -> DataFrame:
        return self._stream(SILVER_WATCHLIST)

    def _matches(self) -> DataFrame:
        """By state, with the salts and hot cards that the checkpoint began with."""
        if self.match_by != "state":
            return match_cards(self._payments(), self._entries())
        kept = kept_state(self.spark, self.checkpoint(CARD_MATCHES))
        if kept is None:
            salts = SALTS if self.salts is None else self.salts
            parts = self.partitions or int(self.spark.conf.get(PARTITIONS))
            hot = hot_keys(self._snapshot(SILVER_TRANSACTIONS), "card_number", parts)
        else:
            salts = kept["match"]["salts"] if self.salts is None else self.salts
            hot = kept["match"]["hot"]
        return match_cards(
            self._stream(SILVER_TRANSACTIONS),
            self._stream(SILVER_WATCHLIST),
            salts=salts,
            hot=hot,
        )

    def _stream(self, table: str) -> DataFrame:
        return self.spark.readStream.options(**self.limits).table(self.table(table))

    def _snapshot(self, table: str) -> DataFrame:
        return self.spark.read.table(self.table(table))

    def _start(self, table: StreamTable, trigger: Mapping[str, object]) -> StreamingQuery:
        name, checkpoint = self.table(table.name), self.checkpoint(table.name)
        if table.joined:
            return append_joined(
                *[side() for side in table.joined],
                ("card_number", "entity_id"),
                match_cards,
                name,
                f"{self.folder}/history/{table.name}",
                checkpoint,
                trigger,
            )
        if table.enrich:
            return append_batches(
                table.build(),
                table.enrich,
                name,
                checkpoint,
                trigger,
                [fold.step(f"{self.folder}/dashboard/{kept}") for kept, fold in table.folds.items()],
                table.expectations,
                self.counts(table.name),
            )
        return append_to_table(
            table.build(),
            name,
            checkpoint,
            trigger,
            table.stateful,
            self.partitions,
            self.table_format,
        )

    def _start_outboxes(self, trigger: Mapping[str, object]) -> list[StreamingQuery]:
        renderers = {
            LIMIT_ALERTS: render_limit_notifications,
            CARD_ALERTS: render_card_notifications,
        }
        return [
            attach_outbox(
                self._stream(table),
                render,
                self.outbox(table),
                self.checkpoint(f"outbox.{table}"),
                self.notify,
                trigger,
                self.table(table),
            )
            for table, render in renderers.items()
        ]
