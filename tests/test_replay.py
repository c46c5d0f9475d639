"""Batches that are run again after a failure: rows, mails, counts and summaries once."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardinel.operators import limit_alerts
from cardinel.operators.quality import TRANSACTION_DROP, TRANSACTION_WARN, Expectation
from cardinel.plans import dashboard
from cardinel.plans.notifications import render_limit_notifications
from cardinel.streaming import (
    Fold,
    FoldLost,
    append_batches,
    attach_outbox,
    create_layers,
    declare,
    finish,
    first_rows,
    outbox_stats,
    read_outbox,
    rule_totals,
    sums,
)
from cardinel.streaming import batches
from helpers import Feed, at, customers, transactions

EXPECTED = (
    Expectation("warn", TRANSACTION_WARN),
    Expectation("drop", TRANSACTION_DROP, drop=True),
)


class Killed(Exception):
    pass


class Job:
    """A table that a feed's batches are appended to, and an outbox that reads it."""

    def __init__(self, spark, tmp_path, build, schema):
        self.spark, self.folder, self.build = spark, str(tmp_path), build
        self.feed = Feed(spark, tmp_path / "feed", transactions(spark).schema)
        layer = f"replay_{uuid.uuid4().hex[:8]}"
        create_layers(spark, [layer], f"{self.folder}/tables")
        self.table = f"{layer}.rows"
        declare(spark, self.table, schema, "", "gold", partition_by=["batch"])

    def stream(self):
        rows = self.spark.readStream.schema(self.feed.schema).option("maxFilesPerTrigger", 1)
        return rows.parquet(self.feed.folder)

    def append(self, **more):
        finish(append_batches(self.stream(), self.build, self.table, f"{self.folder}/point", **more))

    def killed(self, **more):
        with pytest.raises(Exception, match="Killed"):
            self.append(**more)

    def deliver(self):
        finish(
            attach_outbox(
                self.spark.readStream.table(self.table), render_limit_notifications,
                f"{self.folder}/outbox", f"{self.folder}/outbox-point", table=self.table,
            )
        )

    def rows(self):
        self.spark.catalog.refreshTable(self.table)
        return self.spark.read.table(self.table)

    def counts(self, metric="drop"):
        return {r.rule: r.n for r in rule_totals(self.spark, f"{self.folder}/rules", metric).collect()}


def die(*_):
    raise Killed


@pytest.fixture
def alerts(spark, tmp_path):
    people = customers(spark, {})
    build = lambda batch: limit_alerts(batch, people)
    schema = build(transactions(spark)).withColumn("batch", F.lit("")).schema
    return Job(spark, tmp_path, build, schema)


def test_mails_are_there_once_though_the_alerts_are_written_again(spark, alerts):
    """Two alerts are written, their batch dies before its commit, the outbox reads them."""
    alerts.feed.add(transactions(spark, {"transaction_id": "T1"}, {"transaction_id": "T2"}))
    alerts.killed(steps=[die])
    alerts.deliver()
    alerts.append()
    alerts.deliver()
    assert alerts.rows().count() == 2
    mails = read_outbox(spark, f"{alerts.folder}/outbox")
    assert sorted(r.alert_id for r in mails.collect()) == ["ALERT-T1", "ALERT-T2"]
    assert [r.total for r in outbox_stats(mails).collect()] == [2]


def test_mails_are_those_of_a_batch_that_was_replaced(spark, alerts):
    """As if by a table that cannot tell that the batch is there: files come a second time."""
    alerts.feed.add(transactions(spark, {"transaction_id": "T1"}, {"transaction_id": "T2"}))
    alerts.append()
    alerts.deliver()
    key = alerts.rows().first().batch
    rows = alerts.rows().drop("batch")
    again = spark.createDataFrame(rows.collect(), rows.schema)
    batches.write_batch(again, alerts.table, key)
    alerts.deliver()
    mails = read_outbox(spark, f"{alerts.folder}/outbox")
    assert sorted(r.alert_id for r in mails.collect()) == ["ALERT-T1", "ALERT-T2"]


def test_mails_of_a_batch_that_is_read_in_parts(spark, alerts):
    rows = [{"transaction_id": f"T{i}"} for i in range(40)]
    alerts.feed.add(transactions(spark, *rows))
    build, alerts.build = alerts.build, lambda batch: alerts_of(batch).repartition(8)
    alerts_of = build
    alerts.append()
    finish(
        attach_outbox(
            spark.readStream.option("maxFilesPerTrigger", 1).table(alerts.table),
            render_limit_notifications, f"{alerts.folder}/outbox", f"{alerts.folder}/outbox-point",
            table=alerts.table,
        )
    )
    mails = read_outbox(spark, f"{alerts.folder}/outbox")
    assert mails.count() == 40 and mails.select("alert_id").distinct().count() == 40


def test_what_a_batch_said_first_holds(spark, tmp_path):
    """The customer is gone when the batch is run again."""
    known = [customers(spark, {})]
    build = lambda batch: limit_alerts(batch, known[0])
    schema = build(transactions(spark)).withColumn("batch", F.lit("")).schema
    job = Job(spark, tmp_path, build, schema)
    job.feed.add(transactions(spark, {"transaction_id": "T1"}))
    job.killed(steps=[die])
    known[0] = customers(spark)
    job.append()
    assert [r.alert_id for r in job.rows().collect()] == ["ALERT-T1"]


def test_a_batch_without_rows_is_done_too(spark, tmp_path):
    known = [customers(spark)]
    build = lambda batch: limit_alerts(batch, known[0])
    schema = build(transactions(spark)).withColumn("batch", F.lit("")).schema
    job = Job(spark, tmp_path, build, schema)
    job.feed.add(transactions(spark, {"transaction_id": "T1"}))
    job.killed(steps=[die])
    known[0] = customers(spark, {})
    job.append()
    assert job.rows().count() == 0


@pytest.fixture
def silver(spark, tmp_path):
    schema = transactions(spark).withColumn("batch", F.lit("")).schema
    return Job(spark, tmp_path, lambda batch: batch, schema)


@pytest.mark.parametrize("moment", ["before the rows", "after the rows", "before the counts",
                                    "after the counts", "in a step"])
def test_rule_counts_are_exact_wherever_a_batch_dies(spark, silver, monkeypatch, moment):
    counted = {"expectations": EXPECTED, "counts": f"{silver.folder}/rules"}
    rows = [{}, {"transaction_id": None}, {"amount": -1.0}, {"card_number": None, "amount": None}]
    for number in range(3):
        silver.feed.add(transactions(spark, *rows[: number + 2]))
        write, add = batches.write_batch, Fold.add
        with monkeypatch.context() as patched:
            if moment.endswith("rows"):
                def fails(*args):
                    if moment == "after the rows":
                        write(*args)
                    raise Killed
                patched.setattr(batches, "write_batch", fails)
            elif moment.endswith("counts"):
                def fails(*args):
                    if moment == "after the counts":
                        add(*args)
                    raise Killed
                patched.setattr(Fold, "add", fails)
            silver.killed(**counted, steps=[die])
        silver.append(**counted)
        silver.append(**counted)
    assert silver.rows().count() == 1 + 2 + 2
    drop, warn = silver.counts("drop"), silver.counts("warn")
    assert drop["rows"] == warn["rows"] == 2 + 3 + 4
    assert drop["valid_transaction_id"] == 3 and drop["valid_card_number"] == 1
    assert warn["valid_transaction_amount"] == 2 + 1


def test_counts_of_many_batches_are_kept_in_a_few_files(spark, silver):
    """Each file is a batch, of one row that breaks a rule and one that does not."""
    import os

    n = 30
    silver.build = lambda batch: batch.drop("part")
    pairs = transactions(spark, *[r for i in range(n) for r in ({"customer_id": f"C{i}"}, {"customer_id": f"C{i}", "amount": -1.0})])
    pairs.withColumn("part", F.col("customer_id")).repartition(8, "part").write.partitionBy("part").mode(
        "append"
    ).parquet(silver.feed.folder)
    files = [f for _, _, names in os.walk(silver.feed.folder) for f in names if f.endswith(".parquet")]
    assert len(files) == n
    silver.append(expectations=EXPECTED, counts=f"{silver.folder}/rules")
    assert silver.rows().select("batch").distinct().count() == n
    assert silver.counts("warn") == {"rows": 2 * n, "valid_transaction_amount": n}
    kept = [f for _, _, names in os.walk(f"{silver.folder}/rules") for f in names if f.endswith(".parquet")]
    assert len(kept) <= 8
    # A new checkpoint begins at batch 0 and counts for itself.
    silver.folder, rules = silver.folder + "/again", f"{silver.folder}/rules"
    silver.append(expectations=EXPECTED, counts=rules)
    totals = {r.rule: r.n for r in rule_totals(spark, rules, "warn").collect()}
    assert totals == {"rows": 4 * n, "valid_transaction_amount": 2 * n}


COUNT = Fold(
    T.StructType().add("k", "string").add("n", "long"),
    lambda rows: rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")),
    sums(["k"], ["n"]),
)


def test_folds(spark, tmp_path):
    folder = str(tmp_path / "fold")
    assert COUNT.read(spark, folder).count() == 0
    part = lambda *keys: spark.createDataFrame([(k,) for k in keys], "k string")
    COUNT.add(part("a", "a", None), folder, "12e5", 7)
    COUNT.add(part("zzz"), folder, "12e5", 7)
    COUNT.add(part(), folder, "12e5", 8)
    for number in range(9, 30):
        COUNT.add(part("b"), folder, "12e5", number)
        COUNT.add(part("zzz"), folder, "12e5", number)
    COUNT.add(part("b"), folder, "007", 0)
    got = {r.k: r.n for r in COUNT.read(spark, folder).collect()}
    assert got == {"a": 2, None: 1, "b": 22}
    with pytest.raises(FoldLost):
        COUNT.add(part("b"), folder, "12e5", 31)


def test_latest_rows_are_those_of_the_whole(spark, tmp_path):
    fold = Fold(
        T.StructType().add("at", "long").add("id", "string"),
        lambda rows: rows.orderBy(F.desc("at"), "id").limit(5),
        first_rows({"at": False, "id": True}, 5),
    )
    rows = [(i * 7 % 11, f"id{i}") for i in range(40)]
    for number in range(10):
        part = spark.createDataFrame(rows[4 * number : 4 * number + 4], fold.schema)
        fold.add(part, str(tmp_path), "w", number)
    want = sorted(rows, key=lambda r: (-r[0], r[1]))[:5]
    got = fold.read(spark, str(tmp_path)).orderBy(F.desc("at"), "id").collect()
    assert [tuple(r) for r in got] == want


def test_dashboard_from_summaries_equals_the_full_scan(spark, silver, tmp_path):
    """Over several batches, one of which is run twice."""
    folder = str(tmp_path / "dashboard")
    people = customers(spark, {}, {"customer_id": "C2", "email": None})
    for i in range(4):
        rows = [
            {"transaction_id": f"T{i}-{k}", "customer_id": f"C{k % 3}", "amount": k + 0.25,
             "city": f"city{k % (i + 2)}", "is_international": (None, True, False)[k % 3],
             "merchant_category": f"m{k % 13}", "transaction_timestamp": at(f"2024-01-0{i + 1} 00:00:{k:02}")}
            for k in range(30)
        ]
        silver.feed.add(transactions(spark, *rows))
    alert = lambda rows: limit_alerts(rows, people, now=F.col("transaction_timestamp"))
    from cardinel.operators.alerts import card_alerts
    from helpers import watchlist

    entries = watchlist(spark, {}, {"watchlist_id": "WL2", "risk_level": "low", "reason_code": None})
    card = lambda rows: card_alerts(rows, entries, people, now=F.col("transaction_timestamp"))
    died = []

    def summaries(rows, writer, number):
        for folds, of in (
            (dashboard.OF_TRANSACTIONS, rows),
            (dashboard.OF_LIMIT_ALERTS, alert(rows)),
            (dashboard.OF_CARD_ALERTS, card(rows)),
        ):
            for name, fold in folds.items():
                fold.add(of, f"{folder}/{name}", writer, number)
                if number == 2 and not died:
                    died.append(name)
                    raise Killed

    silver.killed(steps=[summaries])
    silver.append(steps=[summaries])
    from cardinel.operators import count_tumbling

    rows = silver.rows()
    minutes = count_tumbling(rows)
    want = dashboard.datasets(rows, minutes, alert(rows), card(rows))
    got = dashboard.summarised(spark, folder, minutes)
    assert got.keys() == want.keys()
    for name in want:
        assert [tuple(r) for r in got[name].collect()] == [tuple(r) for r in want[name].collect()], name
        assert got[name].columns == want[name].columns
