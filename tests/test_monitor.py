"""The whole job from files, table declarations and the reset guard."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from cardinel.plans import monitor as job
from cardinel.schemas import TRANSACTION
from cardinel.sources.versions import SchemaLog
from cardinel.streaming import (
    StateChanged,
    append_to_table,
    create_layers,
    declare,
    finish,
    read_outbox,
    reset,
    table_properties,
)
from cardinel.streaming.tables import ResetRefused
from helpers import Feed, at, customers, raw_watchlist, transactions


@pytest.fixture
def layer(spark, tmp_path):
    name = f"layer_{uuid.uuid4().hex[:8]}"
    create_layers(spark, [name], str(tmp_path))
    create_layers(spark, [name], str(tmp_path))
    return name


def test_declared_table(spark, layer):
    table = f"{layer}.t"
    declare(spark, table, TRANSACTION, "It's a table", "silver", protected=True)
    declare(spark, table, TRANSACTION, "Another comment", "gold")
    properties = table_properties(spark, table)
    assert properties["quality"] == "silver"
    assert properties["pipelines.reset.allowed"] == "false"
    assert spark.catalog.getTable(table).description == "It's a table"
    assert spark.read.table(table).columns == TRANSACTION.names
    assert spark.read.table(table).count() == 0


def test_reset_of_a_protected_table_is_refused(spark, layer, tmp_path):
    feed = Feed(spark, tmp_path / "in", TRANSACTION).add(transactions(spark, {}, {}))
    checkpoint = str(tmp_path / "checkpoint")
    for table, protected in ((f"{layer}.kept", True), (f"{layer}.loose", False)):
        point = f"{checkpoint}/{table}"
        declare(spark, table, TRANSACTION, "", "silver", protected)
        finish(append_to_table(feed.stream(), table, point))
        if protected:
            with pytest.raises(ResetRefused):
                reset(spark, table)
            assert os.path.exists(point)
        else:
            reset(spark, table)
            assert not spark.catalog.tableExists(table)
            declare(spark, table, TRANSACTION, "", "silver", protected)
            finish(append_to_table(feed.stream(), table, f"{point}-2"))
        assert spark.read.table(table).count() == 2


class Inputs:
    """Message and watchlist files, and a job that reads them."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        (folder / "landed").mkdir()
        rows = self._messages(transactions(spark))
        self.feed = Feed(spark, folder / "messages", rows.schema)
        self.prefix = f"job_{uuid.uuid4().hex[:8]}_"

    def monitor(self, **changes):
        return job.Monitor(
            self.spark,
            folder=str(self.folder / "job"),
            messages=self.feed.stream,
            watchlist_folder=str(self.folder / "landed"),
            own_layers=True,
            prefix=self.prefix,
            **changes,
        )

    def pay(self, *rows):
        self.feed.add(self._messages(transactions(self.spark, *rows)))

    def list(self, *rows):
        entries = raw_watchlist(self.spark, *rows)
        entries.coalesce(1).write.mode("append").json(str(self.folder / "landed"))

    def _messages(self, rows):
        return rows.select(
            F.col("transaction_id").cast("binary").alias("key"),
            F.to_json(F.struct("*")).cast("binary").alias("value"),
            F.lit("t").alias("topic"),
            F.lit(0).alias("partition"),
            F.lit(0).cast("long").alias("offset"),
            F.current_timestamp().alias("timestamp"),
            F.lit(0).alias("timestampType"),
        )


def counts(spark, monitor):
    names = [table.name for stage in monitor.stages() for table in stage]
    return {name: spark.read.table(monitor.table(name)).count() for name in names}


def rules(monitor, metric):
    return {row.rule: row.n for row in monitor.rule_counts(metric).collect()}


@pytest.mark.parametrize("match_by", ["history", "state"])
def test_two_runs_take_in_only_what_is_new(spark, tmp_path, match_by):
    inputs = Inputs(spark, tmp_path)
    monitor = inputs.monitor(match_by=match_by, salts=4)
    monitor.set_up()
    people = customers(spark, {}, {"customer_id": None})
    people.write.insertInto(monitor.table(job.BRONZE_CUSTOMERS))
    inputs.pay({}, {"transaction_id": "T2", "card_number": "4999"}, {"transaction_id": None})
    inputs.list({})
    monitor.run_once()
    assert counts(spark, monitor) == {
        job.BRONZE_TRANSACTIONS: 3,
        job.BRONZE_WATCHLIST: 1,
        job.SILVER_TRANSACTIONS: 2,
        job.SILVER_WATCHLIST: 1,
        job.SILVER_CUSTOMERS: 1,
        job.LIMIT_ALERTS: 2,
        job.CARD_MATCHES: 1,
        job.TUMBLING_COUNTS: 0,
        job.SLIDING_COUNTS: 0,
        job.CARD_ALERTS: 1,
    }
    assert rules(monitor, "transactions_drop")["valid_transaction_id"] == 1
    assert rules(monitor, "transactions_warn")["rows"] == 3

    # The second run goes on with the salts it began with, and does so for no others.
    monitor = inputs.monitor(match_by=match_by)
    if match_by == "state":
        with pytest.raises(StateChanged):
            inputs.monitor(match_by=match_by, salts=16).run_once()
    inputs.pay({"transaction_id": "T3", "transaction_timestamp": at("2024-01-01 00:20:00")})
    inputs.list({"watchlist_id": "WL000002", "entity_id": "4999"})
    monitor.run_once()
    after = counts(spark, monitor)
    assert after[job.LIMIT_ALERTS] == 3
    assert after[job.TUMBLING_COUNTS] == 1
    assert after[job.SLIDING_COUNTS] == 5
    alerts = spark.read.table(monitor.table(job.CARD_ALERTS))
    assert {row.alert_id for row in alerts.collect()} == {
        "FRAUD-T1-WL000001",
        "FRAUD-T2-WL000002",
        "FRAUD-T3-WL000001",
    }
    mails = read_outbox(spark, monitor.outbox(job.CARD_ALERTS))
    assert sorted((row.batch_id, row.alert_id) for row in mails.collect()) == [
        (0, "FRAUD-T1-WL000001"),
        (1, "FRAUD-T2-WL000002"),
        (1, "FRAUD-T3-WL000001"),
    ]

    assert rules(monitor, "transactions_warn")["rows"] == 4
    again = counts(spark, monitor)
    monitor.run_once()
    assert counts(spark, monitor) == again

    shown = monitor.dashboard()
    assert shown["total_transactions"].first()[0] == 3
    assert shown["fraud_card_alerts_count"].first()[0] == 3
    assert shown["txn_by_minute"].count() == 1


def test_tables_carry_their_layer_and_guard(spark, tmp_path):
    monitor = Inputs(spark, tmp_path).monitor()
    monitor.set_up()
    for table in (table for stage in monitor.stages() for table in stage):
        properties = table_properties(spark, monitor.table(table.name))
        assert properties["quality"] == table.name.split(".")[0]
        protected = table.name in (
            job.BRONZE_TRANSACTIONS,
            job.BRONZE_WATCHLIST,
            job.SILVER_WATCHLIST,
            job.SILVER_CUSTOMERS,
        )
        assert properties["pipelines.reset.allowed"] == str(not protected).lower()


def test_running_side_by_side_without_notifications(spark, tmp_path):
    inputs = Inputs(spark, tmp_path)
    monitor = inputs.monitor(salts=2, notify=False, limits={"maxFilesPerTrigger": "1"})
    inputs.pay({"customer_id": "C9"})
    inputs.list({})
    queries = monitor.start({"processingTime": "0 seconds"})
    try:
        for query in queries:
            query.processAllAvailable()
        inputs.pay({"transaction_id": "T2"})
        for query in queries:
            query.processAllAvailable()
        alerts = spark.read.table(monitor.table(job.CARD_ALERTS))
        assert {row.transaction_id for row in alerts.collect()} == {"T1", "T2"}
    finally:
        monitor.stop(queries)
    assert not os.path.exists(monitor.outbox(job.CARD_ALERTS))


def test_customer_who_arrives_while_the_job_runs(spark, tmp_path):
    inputs = Inputs(spark, tmp_path)
    monitor = inputs.monitor(notify=False)
    inputs.list({})
    inputs.pay({"transaction_id": "T0", "customer_id": "C0"})
    queries = monitor.start({"processingTime": "0 seconds"})
    try:
        people = customers(spark, {})
        people.write.insertInto(monitor.table(job.BRONZE_CUSTOMERS))
        for query in queries:
            query.processAllAvailable()
        inputs.pay({"transaction_id": "T1"})
        for query in queries:
            query.processAllAvailable()
        limits = spark.read.table(monitor.table(job.LIMIT_ALERTS)).collect()
        assert [row.transaction_id for row in limits] == ["T1"]
        cards = spark.read.table(monitor.table(job.CARD_ALERTS)).collect()
        assert {row.transaction_id: row.customer_email for row in cards} == {
            "T0": None,
            "T1": "ann@example.com",
        }
    finally:
        monitor.stop(queries)
    monitor.run_once()
    assert spark.read.table(monitor.table(job.LIMIT_ALERTS)).count() == 1


def test_the_watchlist_follows_its_feed(spark, tmp_path):
    """New fields and wider types, in later runs and within one; no value is lost."""
    inputs = Inputs(spark, tmp_path)
    monitor = inputs.monitor(infer=True, notify=False, limits={"maxFilesPerTrigger": "1"})
    days = [
        ['{"watchlist_id":"WL1","score":3}', "cut off {"],
        ['{"watchlist_id":"WL2","score":4.5,"note":1}', '[{"watchlist_id":"WL3","tags":["a"]}]'],
        ['{"watchlist_id":"WL4","score":"high","note":{"by":"x"},"tags":["b"]}'],
        ['{"watchlist_id":"WL5","score":7,"note":2,"Extra":true}'],
    ]
    columns = []
    for number, lines in enumerate(days):
        landed = tmp_path / "landed" / f"{number}.json"
        landed.write_text("\n".join(lines) + "\n")
        os.utime(landed, (1.7e9 + number,) * 2)  # files of one time come in any order
        if number != 2:  # the third comes with the fourth
            monitor.run_once()
            spark.catalog.refreshTable(monitor.table(job.BRONZE_WATCHLIST))
            bronze = spark.read.table(monitor.table(job.BRONZE_WATCHLIST))
            columns.append({"score", "note", "tags", "Extra"} & set(bronze.columns))
    assert columns == [{"score"}, {"score", "note", "tags"}, {"score", "note", "tags", "Extra"}]
    got = {r.watchlist_id: (r.score, r.note, r.tags, r.Extra) for r in monitor.watchlist_entries().collect()}
    assert got == {
        "WL1": ("3", None, None, None),
        "WL2": ("4.5", "1", None, None),
        "WL3": (None, None, ["a"], None),
        "WL4": ("high", '{"by":"x"}', ["b"], None),
        "WL5": ("7", "2", None, True),
        None: (None, None, None, None),
    }
    log = SchemaLog(spark, f"{monitor.folder}/schema/watchlist")
    kinds = [{f.name: f.dataType.simpleString() for f in fields} for _, _, fields in log.versions()]
    assert kinds == [
        {"score": "bigint"},
        {"score": "double", "note": "bigint", "tags": "array<string>"},
        {"score": "string", "note": "string", "tags": "array<string>"},
        {"score": "string", "note": "string", "tags": "array<string>", "Extra": "boolean"},
    ]
    again = monitor.watchlist_entries().count()
    monitor.run_once()
    assert monitor.watchlist_entries().count() == again == 6
    assert len(log.versions()) == 4


def test_partitioned_table(spark, layer, tmp_path):
    feed = Feed(spark, tmp_path / "in", TRANSACTION)
    feed.add(transactions(spark, {"city": "A"}, {"city": "B"}))
    table = f"{layer}.parted"
    declare(spark, table, TRANSACTION, "", "silver", partition_by=["city"])
    point = str(tmp_path / "point")
    finish(append_to_table(feed.stream(), table, point, partition_by=["city"]))
    assert {row.city for row in spark.read.table(table).collect()} == {"A", "B"}
    assert spark.sql(f"SHOW PARTITIONS {table}").count() in (0, 2)
