import json

import pytest
from pyspark.sql import types as T

from cardinel.session import work_folder
from cardinel.sources import (
    KafkaSource,
    envelope,
    export_entries,
    infer_schema,
    landed_mark,
    new_entries,
    parse_watchlist,
    read_json_lines,
    read_landed,
    read_watchlist_csv,
    stream_json_lines,
)
from cardinel.streaming import append_to_path, finish
from helpers import raw_watchlist

DETAILS = {"bootstrap_servers": "b:9092", "topic": "payments", "api_key": "k", "api_secret": 's"1'}


def test_kafka_options():
    source = KafkaSource.from_json(json.dumps(DETAILS), extra={"maxOffsetsPerTrigger": "1000"})
    options = source.options()
    assert options == {
        "kafka.bootstrap.servers": "b:9092",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": (
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            'username="k" password="s\\"1";'
        ),
        "subscribe": "payments",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
    }
    assert DETAILS["api_secret"] not in repr(source)


def test_kafka_details_must_be_complete():
    with pytest.raises(KeyError):
        KafkaSource.from_json('{"topic": "payments"}')


def test_envelope(spark):
    message = (bytearray(b"k"), bytearray("é".encode()), "t", 3, 9, None, 0)
    columns = (
        "key binary, value binary, topic string, partition int, offset bigint, "
        "timestamp timestamp, timestampType int"
    )
    row = envelope(spark.createDataFrame([message], columns)).first()
    assert (row.key, row.value, row.partition, row.offset) == ("k", "é", 3, 9)
    assert row.ingestion_ts is not None
    plain = envelope(spark.createDataFrame([message], columns), stamped=False)
    assert len(plain.columns) == 7


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landed"
    folder.mkdir()

    def land(name, *lines):
        (folder / name).write_text("\n".join(lines) + "\n")

    return folder, land


def test_rescued_data(spark, landing):
    folder, land = landing
    land(
        "a.json",
        '{"watchlist_id":"WL1","score":1.5}',
        '{"watchlist_id":"WL2","score":"high","extra":1,"more":{"a":[1,2]}}',
        "",
        '{"watchlist_id":7,"score":null}',
        "broken",
    )
    schema = T.StructType().add("watchlist_id", "string").add("score", "double")
    rows = parse_watchlist(read_json_lines(spark, str(folder)), schema).collect()
    got = {row.watchlist_id: (row.score, row._rescued_data) for row in rows}
    assert got == {
        "WL1": (1.5, None),
        "WL2": (None, '{"score":"high","extra":"1","more":"{\\"a\\":[1,2]}"}'),
        "7": (None, None),
        None: (None, "broken"),
    }
    assert rows[0].file_path.endswith("/a.json")


def test_no_watchlist_text_is_lost(spark, landing):
    folder, land = landing
    lines = ['{"watchlist_id":"WL1","sco', "just a line", "12", '[{"watchlist_id":"WL2"']
    arrays = ['[{"watchlist_id":"WL3","score":2},{"watchlist_id":"WL4","x":true}]', " [ ] "]
    land("a.json", *lines, *arrays)
    schema = T.StructType().add("watchlist_id", "string").add("score", "double")
    rows = parse_watchlist(read_json_lines(spark, str(folder)), schema).collect()
    got = sorted((str(r.watchlist_id), r.score, r._rescued_data) for r in rows)
    assert got == sorted(
        [("None", None, line) for line in [*lines, " [ ] "]]
        + [("WL3", 2.0, None), ("WL4", None, '{"x":"true"}')],
    )


def test_each_file_is_picked_up_once(spark, landing, tmp_path):
    folder, land = landing
    out = str(tmp_path / "out")

    def run():
        bronze = parse_watchlist(stream_json_lines(spark, str(folder)))
        finish(append_to_path(bronze, out, str(tmp_path / "checkpoint")))
        return sorted(row.watchlist_id for row in spark.read.parquet(out).collect())

    land("a.json", '{"watchlist_id":"WL1"}')
    assert run() == ["WL1"]
    assert run() == ["WL1"]
    land("b.json", '{"watchlist_id":"WL2"}', '{"watchlist_id":"WL3"}')
    assert run() == ["WL1", "WL2", "WL3"]


def test_schema_is_inferred_once(spark, landing, tmp_path):
    folder, land = landing
    location = str(tmp_path / "schema")
    land("a.json", '{"watchlist_id":"WL1","score":3}')
    first = infer_schema(spark, str(folder), location)
    assert [(f.name, f.dataType.simpleString()) for f in first] == [
        ("score", "bigint"),
        ("watchlist_id", "string"),
    ]
    land("b.json", '{"watchlist_id":"WL2","score":"x","new":true}')
    assert infer_schema(spark, str(folder), location) == first
    rows = parse_watchlist(read_json_lines(spark, str(folder)), first).collect()
    assert {row.watchlist_id: row._rescued_data for row in rows} == {
        "WL1": None,
        "WL2": '{"score":"x","new":"true"}',
    }


def test_export_adds_only_what_is_new(spark, tmp_path):
    csv, landed = str(tmp_path / "csv"), str(tmp_path / "landed")

    def export(*numbers):
        entries = [{"watchlist_id": f"WL{n:06}", "entity_id": "0042"} for n in numbers]
        raw_watchlist(spark, *entries).write.mode("overwrite").csv(csv, header=True)
        rows = new_entries(read_watchlist_csv(spark, csv), read_landed(spark, landed)).collect()
        export_entries(spark, csv, landed)
        return sorted(row.watchlist_id for row in rows)

    assert export(1, 2, 3) == ["WL000001", "WL000002", "WL000003"]
    assert export(1, 2, 3, 4, 10) == ["WL000004", "WL000010"]
    assert export(1, 2, 3, 4, 10) == []
    ids = [row.watchlist_id for row in read_landed(spark, landed).collect()]
    assert len(ids) == len(set(ids)) == 5
    assert parse_watchlist(read_json_lines(spark, landed)).first().entity_id == "0042"


@pytest.mark.parametrize(
    "landed, mark",
    [
        (["WL000003", "XX000009", "WLx", None, "9"], 3),
        (["XX1"], None),
        (["WL000000"], None),
        ([], None),
    ],
)
def test_landed_mark(spark, landed, mark):
    ids = spark.createDataFrame([(i,) for i in landed], "watchlist_id string")
    assert landed_mark(ids).first().mark == mark


def test_work_folder_is_in_the_shared_checkpoint_folder(spark):
    assert spark.conf.get("spark.checkpoint.dir", None)
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first.startswith(spark.conf.get("spark.checkpoint.dir") + "/")
    assert first != second
