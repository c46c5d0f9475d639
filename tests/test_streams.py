"""Watermarks, late rows and state, over several runs from one checkpoint."""

import datetime as dt
import os
import random
from collections import Counter

import pytest

from cardinel.operators import card_alerts, count_sliding, count_tumbling, expect_warn
from cardinel.operators.alerts import match_cards
from cardinel.operators.quality import TRANSACTION_WARN
from cardinel.operators.skew import hot_keys
from cardinel.operators.windows import late_candidates, missed
from cardinel.session import STATEFUL, settings
from cardinel.streaming import (
    ProgressKeeper,
    StateChanged,
    append_to_path,
    finish,
    kept_counts,
    kept_late_rows,
    kept_state,
    late_rows,
    read_reports,
    state_rows,
)
from helpers import Feed, at, customers, transactions, watchlist


def run(df, folder):
    query = append_to_path(df, f"{folder}/out", f"{folder}/checkpoint", stateful=True)
    finish(query)
    return query


def read(spark, folder):
    return spark.read.parquet(f"{folder}/out").collect()


def paid(spark, *times, **values):
    return transactions(
        spark, *[{"transaction_timestamp": at(time) if time else None, **values} for time in times]
    )


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "transactions", transactions(spark).schema)


@pytest.fixture
def listed(spark, tmp_path):
    return Feed(spark, tmp_path / "watchlist", watchlist(spark).schema)


def test_windows_close_with_the_watermark_and_late_rows_are_dropped(spark, feed, tmp_path):
    feed.add(paid(spark, "2024-01-01 00:00:10", "2024-01-01 00:00:50", "2024-01-01 00:10:10"))
    run(count_tumbling(feed.stream()), tmp_path)
    first = [(row.window_start, row.transaction_count) for row in read(spark, tmp_path)]
    assert first == [(dt.datetime(2024, 1, 1), 2)]

    feed.add(paid(spark, "2024-01-01 00:00:30", "2024-01-01 00:15:00", None))
    query = run(count_tumbling(feed.stream()), tmp_path)
    assert late_rows(query) == 1
    assert len(read(spark, tmp_path)) == 1

    feed.add(paid(spark, "2024-01-01 00:16:00"))
    run(count_tumbling(feed.stream()), tmp_path)
    starts = {row.window_start: row.transaction_count for row in read(spark, tmp_path)}
    assert starts == {dt.datetime(2024, 1, 1): 2, dt.datetime(2024, 1, 1, 0, 10): 1}


def test_row_on_an_edge_opens_the_next_window(spark):
    rows = paid(spark, "2024-01-01 00:01:00")
    row = count_tumbling(rows).first()
    assert (row.window_start.minute, row.window_end.minute) == (1, 2)
    starts = sorted(row.window_start for row in count_sliding(rows).collect())
    assert starts[0] == dt.datetime(2023, 12, 31, 23, 57)
    assert starts[-1] == dt.datetime(2024, 1, 1, 0, 1)
    assert len(starts) == 5


@pytest.mark.parametrize("size", [60, 90, 120, 300])
def test_sliding_counts_equal_brute_force(spark, size):
    draw = random.Random(size)
    start = at("2024-01-01 00:00:00")
    times = [start + dt.timedelta(seconds=draw.randrange(1200)) for _ in range(200)]
    rows = transactions(spark, *[{"transaction_timestamp": time} for time in times])
    got = {
        row.window_start: row.transaction_count
        for row in count_sliding(rows, f"{size} seconds", "1 minute").collect()
    }
    want = Counter()
    for time in times:
        for minute in range(-10, 21):
            opened = start + dt.timedelta(minutes=minute)
            if opened <= time < opened + dt.timedelta(seconds=size):
                want[opened.replace(tzinfo=None)] += 1
    assert got == want


def test_late_row_still_counts_in_its_open_sliding_windows(spark, feed, tmp_path):
    """Watermark 00:05:10: the row at 00:02:30 misses the window that ended at 00:05."""
    feed.add(paid(spark, "2024-01-01 00:10:10"))
    run(count_sliding(feed.stream()), tmp_path)
    feed.add(paid(spark, "2024-01-01 00:02:30"))
    run(count_sliding(feed.stream()), tmp_path)
    feed.add(paid(spark, "2024-01-01 01:00:00"))
    run(count_sliding(feed.stream()), tmp_path)
    counts = {row.window_start: row.transaction_count for row in read(spark, tmp_path)}
    early = [start for start in counts if start < dt.datetime(2024, 1, 1, 0, 5)]
    assert sorted(start.minute for start in early) == [1, 2]


def test_one_batch_of_streams_equals_tables(spark, feed, listed, tmp_path):
    rows = transactions(spark, {}, {"transaction_id": "T2", "customer_id": "C9"})
    entries = watchlist(spark, {}, {"watchlist_id": "WL000002", "effective_from": None})
    people = customers(spark, {}, {"email": "other@example.com"})
    feed.add(rows)
    listed.add(entries)
    run(card_alerts(feed.stream(), listed.stream(), people), tmp_path)
    got = sorted((row.alert_id, str(row.customer_email)) for row in read(spark, tmp_path))
    want = card_alerts(rows, entries, people).collect()
    assert got == sorted((row.alert_id, str(row.customer_email)) for row in want)
    assert len(got) == 6


@pytest.mark.parametrize("transactions_first", [True, False])
@pytest.mark.parametrize("salts", [1, 16])
def test_matches_in_either_order_of_arrival(
    spark, feed, listed, tmp_path, transactions_first, salts
):
    arrivals = [
        lambda: feed.add(transactions(spark, {})),
        lambda: listed.add(watchlist(spark, {"effective_from": "02-Jan-2024 00:00:00"})),
    ]
    if not transactions_first:
        arrivals.reverse()
    counts = []
    for arrive in arrivals:
        arrive()
        run(match_cards(feed.stream(), listed.stream(), salts=salts), tmp_path)
        counts.append(len(read(spark, tmp_path)))
    assert counts == [0, 1]


def test_backdated_entry_is_late_but_one_without_time_matches(spark, feed, listed, tmp_path):
    matches = lambda: match_cards(feed.stream(), listed.stream(), salts=1)
    feed.add(transactions(spark, {"transaction_timestamp": at("2024-06-01 00:00:00")}))
    listed.add(watchlist(spark, {"effective_from": "01-May-2024 00:00:00"}))
    run(matches(), tmp_path)
    assert len(read(spark, tmp_path)) == 1

    # A batch drops what is older than the watermark before it, so one more must pass.
    feed.add(transactions(spark, {"card_number": "4999"}))
    assert late_rows(run(matches(), tmp_path)) == 0

    listed.add(
        watchlist(
            spark,
            {"watchlist_id": "WL000002", "effective_from": "01-Jan-2023 00:00:00"},
            {"watchlist_id": "WL000003", "effective_from": None},
        )
    )
    query = run(matches(), tmp_path)
    assert late_rows(query) == 1
    assert {row.watchlist_id for row in read(spark, tmp_path)} == {"WL000001", "WL000003"}
    assert state_rows(query) == 4


def test_a_checkpoint_keeps_its_salts_and_partitions(spark, feed, listed, tmp_path):
    """As if resumed on a larger cluster: other settings are refused, the old ones go on."""
    entries = [{"watchlist_id": f"WL{i:06}", "entity_id": f"4{i}"} for i in range(20)]
    listed.add(watchlist(spark, *entries))

    def pay(first, last):
        feed.add(
            transactions(
                spark,
                *[{"transaction_id": f"T{i}", "card_number": f"4{i % 20}"} for i in range(first, last)],
            )
        )

    pay(0, 20)
    run(match_cards(feed.stream(), listed.stream(), salts=16), tmp_path)
    pay(20, 100)
    with pytest.raises(StateChanged):
        run(match_cards(feed.stream(), listed.stream(), salts=125), tmp_path)
    with pytest.raises(StateChanged):
        run(match_cards(feed.stream(), listed.stream(), salts=16, hot=["41"]), tmp_path)
    with settings(spark, {"spark.sql.shuffle.partitions": "24"}):
        run(match_cards(feed.stream(), listed.stream(), salts=16), tmp_path)
    assert len(read(spark, tmp_path)) == 100
    assert kept_state(spark, f"{tmp_path}/checkpoint")["partitions"] == 8


def test_only_hot_cards_are_copied(spark, feed, listed, tmp_path):
    entries = [{"watchlist_id": f"WL{i:06}", "entity_id": f"4{i}"} for i in range(50)]
    listed.add(watchlist(spark, *entries))
    rows = [
        {"transaction_id": f"T{i}", "card_number": "47" if i % 3 == 0 else f"4{i % 50}"}
        for i in range(120)
    ]
    paid_rows = transactions(spark, *rows)
    feed.add(paid_rows)
    hot = hot_keys(paid_rows, "card_number", 8)
    assert hot == ["47"]
    query = run(match_cards(feed.stream(), listed.stream(), salts=16, hot=hot), tmp_path)
    assert len(read(spark, tmp_path)) == 120
    assert state_rows(query) == 120 + 50 + 15


def test_a_matched_payment_is_written_to_state_once(spark, feed, listed, tmp_path):
    """Its row and the count of its card's rows; the entry's too, and again as matched."""
    listed.add(watchlist(spark, {"entity_id": "41"}))
    feed.add(
        transactions(
            spark, *[{"transaction_id": f"T{i}", "card_number": "41"} for i in range(100)]
        )
    )
    query = run(match_cards(feed.stream(), listed.stream()), tmp_path)
    assert len(read(spark, tmp_path)) == 100
    metrics = query.recentProgress[0].stateOperators[0].customMetrics
    assert metrics["rocksdbPutCount"] == 2 * 100 + 3


def test_state_that_is_not_counted_takes_fewer_lookups(spark, feed, listed, tmp_path):
    """The same matches, also of rows from the run before, which was counted."""
    lookups, matches = [], lambda: match_cards(feed.stream(), listed.stream())
    listed.add(watchlist(spark, {"entity_id": "41"}))
    for number, count_state in enumerate((True, False)):
        rows = [{"transaction_id": f"T{number}-{i}", "card_number": "41"} for i in range(100)]
        feed.add(transactions(spark, *rows))
        places = f"{tmp_path}/out", f"{tmp_path}/checkpoint"
        query = append_to_path(matches(), *places, stateful=True, count_state=count_state)
        finish(query)
        metrics = query.recentProgress[0].stateOperators[0].customMetrics
        lookups.append(metrics["rocksdbGetCount"])
    assert len(read(spark, tmp_path)) == 200
    assert lookups[0] - lookups[1] >= 2 * 100


def test_reports_of_more_than_a_hundred_batches_are_kept(spark, feed, tmp_path):
    """Over two runs; the query object itself remembers a hundred."""

    def files():
        return [name for name in os.listdir(feed.folder) if name.endswith(".parquet")]

    def batches(first, last):
        rows = [({"transaction_id": f"T{i}"}, {"amount": -1.0}) for i in range(first, last)]
        before = len(files())
        pairs = transactions(spark, *[row for pair in rows for row in pair])
        pairs.coalesce(1).write.option("maxRecordsPerFile", 2).mode("append").parquet(feed.folder)
        assert len(files()) - before == last - first
        rows = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1)
        counted = expect_warn(rows.parquet(feed.folder), TRANSACTION_WARN, "warn")
        keeper = ProgressKeeper(spark, f"{tmp_path}/progress").start()
        query = append_to_path(counted, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
        finish(query)
        keeper.stop(query)

    batches(0, 103)
    batches(103, 106)
    reports = read_reports(spark, f"{tmp_path}/progress")
    assert reports.filter("metrics <> '{}'").select("batch_id").distinct().count() >= 106
    counts = {row.rule: row.n for row in kept_counts(reports, "warn").collect()}
    assert counts == {"rows": 212, "valid_transaction_amount": 106}


def test_late_rows_are_kept(spark, feed, tmp_path):
    keeper = ProgressKeeper(spark, f"{tmp_path}/progress").start()
    done = []
    for times in (["2024-01-01 00:10:10"], ["2024-01-01 00:00:30"], ["2024-01-01 00:00:31"]):
        feed.add(paid(spark, *times))
        done.append(run(count_tumbling(feed.stream()), tmp_path))
    keeper.stop(*done)
    reports = read_reports(spark, f"{tmp_path}/progress")
    assert [row.late_rows for row in kept_late_rows(reports).collect()] == [2]


def test_late_rows_are_found_by_the_windows_that_lack_them(spark, feed, tmp_path):
    """Their number is that of Spark's own reports; each run's rows are one batch."""
    keeper = ProgressKeeper(spark, f"{tmp_path}/late", only_late=True).start()
    times = [
        ["2024-01-01 00:00:10", "2024-01-01 00:10:10"],
        ["2024-01-01 00:00:30", "2024-01-01 00:10:30"],
        ["2024-01-01 00:03:31", "2024-01-01 00:30:00"],
        ["2024-01-01 00:10:50", "2024-01-01 00:50:00"],
    ]
    done = []
    for rows in times:
        feed.add(paid(spark, *rows))
        done.append(run(count_tumbling(feed.stream()), tmp_path))
    keeper.stop(*done)
    table = spark.read.schema(feed.schema).parquet(feed.folder)
    counts = spark.read.parquet(f"{tmp_path}/out")
    found = {(r.window_start.minute, r.transaction_count, r.missed) for r in missed(table, counts).collect()}
    assert found == {(0, 2, 1), (3, 1, 1), (10, 3, 1)}
    reports = read_reports(spark, f"{tmp_path}/late")
    assert [r.late_rows for r in kept_late_rows(reports).collect()] == [3]
    assert reports.count() == 3
    near = late_candidates(table, missed(table, counts))
    assert near.count() == 6
    assert missed(table, count_tumbling(table)).count() == 0
    sliding = missed(table, count_sliding(table), "5 minutes", "1 minute")
    assert sliding.count() == 0


def test_state_is_in_rocksdb(spark, feed, tmp_path):
    feed.add(paid(spark, "2024-01-01 00:00:10"))
    query = run(count_tumbling(feed.stream()), tmp_path)
    metrics = query.lastProgress.stateOperators[0].customMetrics
    assert any(name.startswith("rocksdb") for name in metrics)
    for key in STATEFUL:
        assert spark.conf.get(key, None) != STATEFUL[key]
