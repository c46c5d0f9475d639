"""Matches with all earlier rows from files: any order of arrival, hot cards, failures."""

import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from cardinel.operators.alerts import match_cards
from cardinel.streaming import History, append_joined, create_layers, declare, finish
from cardinel.streaming import history
from helpers import Feed, transactions, watchlist


class Matches:
    def __init__(self, spark, tmp_path, **more):
        self.spark, self.folder, self.more = spark, str(tmp_path), more
        self.paid = Feed(spark, tmp_path / "paid", transactions(spark).schema)
        self.listed = Feed(spark, tmp_path / "listed", watchlist(spark).schema)
        layer = f"match_{uuid.uuid4().hex[:8]}"
        create_layers(spark, [layer], f"{self.folder}/tables")
        self.table = f"{layer}.matches"
        rows = match_cards(transactions(spark), watchlist(spark)).withColumn("batch", F.lit(""))
        declare(spark, self.table, rows.schema, "", "gold", partition_by=["batch"])

    def run(self, **more):
        query = append_joined(
            self.paid.stream(), self.listed.stream(), ("card_number", "entity_id"), match_cards,
            self.table, f"{self.folder}/history", f"{self.folder}/point", **self.more, **more,
        )
        finish(query)
        return query

    def pairs(self):
        self.spark.catalog.refreshTable(self.table)
        return sorted((r.transaction_id, r.watchlist_id) for r in self.spark.read.table(self.table).collect())

    def pay(self, *rows):
        self.paid.add(transactions(self.spark, *rows))

    def list(self, *rows):
        self.listed.add(watchlist(self.spark, *rows))


def made(seed, batches):
    """Payments and entries by batch; one card has a third of them from the middle on."""
    draw = random.Random(seed)
    out = []
    for b in range(batches):
        hot = b >= batches // 2
        card = lambda: "4HOT" if hot and draw.random() < 1 / 3 else f"4C{draw.randrange(6)}"
        pay = [{"transaction_id": f"T{b}-{i}", "card_number": card()} for i in range(draw.choice([0, 6, 9]))]
        enter = [
            {"watchlist_id": f"WL{b}-{i}", "entity_id": card(),
             "effective_from": draw.choice(["01-Jan-2000 00:00:00", "01-Jan-2030 00:00:00", None])}
            for i in range(draw.choice([0, 2, 4]))
        ]
        out.append((pay, enter))
    return out


@pytest.mark.parametrize("seed,roll", [(1, 2), (2, 100)])
def test_each_pair_is_found_once_in_any_order(spark, tmp_path, seed, roll):
    matches, want_pay, want_list = Matches(spark, tmp_path, buckets=4, roll=roll), [], []
    for pay, enter in made(seed, 6):
        if pay:
            matches.pay(*pay)
        if enter:
            matches.list(*enter)
        want_pay, want_list = want_pay + pay, want_list + enter
        query = matches.run()
        want = sorted(
            (p["transaction_id"], w["watchlist_id"])
            for p in want_pay for w in want_list if p["card_number"] == w["entity_id"]
        )
        assert matches.pairs() == want
        assert not query.lastProgress or query.lastProgress.stateOperators == []
    assert len(want) > 15


@pytest.mark.parametrize("moment", ["_write", "write_batch", "step"])
def test_pairs_are_there_once_wherever_a_batch_dies(spark, tmp_path, monkeypatch, moment):
    matches = Matches(spark, tmp_path, buckets=2, roll=1)
    want = 0
    for i in range(3):
        matches.pay({"transaction_id": f"T{i}"}, {"transaction_id": f"N{i}", "card_number": None})
        matches.list({"watchlist_id": f"WL{i}"})
        want = (i + 1) ** 2
        left = [i + 1]

        def fails(*args, real=None):
            real(*args)
            left[0] -= 1
            if left[0] == 0:
                raise RuntimeError("killed")

        with monkeypatch.context() as patched:
            more = {}
            if moment == "step":
                left[0] = 1
                more["steps"] = [lambda *args: fails(*args, real=lambda *_: None)]
            elif moment == "write_batch":
                left[0] = 1
                real = history.write_batch
                patched.setattr(history, "write_batch", lambda *a: fails(*a, real=real))
            else:
                real = History._write
                patched.setattr(History, "_write", lambda *a: fails(*a, real=real))
            with pytest.raises(Exception, match="killed"):
                matches.run(**more)
        matches.run()
        assert len(matches.pairs()) == want == len(set(matches.pairs()))


def test_earlier_rows_are_read_from_the_buckets_and_cards_asked_for(spark, tmp_path):
    kept = History(str(tmp_path / "h"), transactions(spark).schema, "card_number", buckets=16)
    rows = [{"transaction_id": f"T{i}", "card_number": f"4{i}"} for i in range(200)]
    kept.add(transactions(spark, *rows), 0)
    asked = spark.createDataFrame([("47",)], "entity_id string")
    found = kept.before(spark, 1, asked)
    assert [r.transaction_id for r in found.collect()] == ["T7"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(card_number,47)" in plan or "In(card_number, [47])" in plan
    assert len(found.inputFiles()) <= 16
    assert kept.before(spark, 0, asked).count() == 0


def test_folders_of_past_batches_are_merged(spark, tmp_path):
    kept = History(str(tmp_path / "h"), transactions(spark).schema, "card_number", buckets=2, roll=4)
    for number in range(14):
        kept.add(transactions(spark, {"transaction_id": f"T{number}"}), number)
    files = [f for _, _, names in os.walk(tmp_path) for f in names if f.endswith(".parquet")]
    assert len(files) == 3 + 2
    asked = spark.createDataFrame([("4111222233334444",)], "entity_id string")
    for number in (12, 14):
        got = {r.transaction_id for r in kept.before(spark, number, asked).collect()}
        assert got == {f"T{i}" for i in range(number)}
