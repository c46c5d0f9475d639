"""Columns named like the operators' own, ids that are texts, and very long texts."""

import importlib
import random
import time

import brute
import pytest
from pyspark.sql import functions as F

from cardinel.llm import conversations, decontamination, mixing, neardup, quality, sharding

SCHEMA = "doc_id string, text string, lang string, source string"
# Names that the operators use inside, or add.
NAMES = [
    "_all", "_key", "_row", "_copies", "_copy", "_at", "_spread", "_shards", "_hash", "_apart",
    "_p", "_n", "score", "rejected", "lang_pred", "n_words", "hits", "items", "component_id",
    "kept", "size", "taken", "shard", "c0", "_lettered", "_bucket", "weight", "node",
]


def texts():
    draw = random.Random(9)
    word = lambda: "".join(draw.choices("abcdefgh", k=draw.randint(2, 7)))
    base = " ".join(word() for _ in range(80))
    rows = [(f"doc-{i}", " ".join(word() for _ in range(60)), "en", f"s{i % 3}") for i in range(20)]
    rows += [(f"copy-{i}", f"{base} {word()}", None, None) for i in range(4)]
    return rows + [(None, None, "de", "s1"), ("nan", "", "en", "s1"), ("7", base, "en", "s2")]


ROWS = texts()


@pytest.fixture(scope="module")
def plain(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def clashing(plain):
    return plain.withColumns({name: F.concat_ws("-", F.lit(name), "doc_id") for name in NAMES})


@pytest.fixture(scope="module")
def benchmark(spark):
    item = " ".join(ROWS[3][1].split(" ")[5:25])
    return spark.createDataFrame([("b", item), (None, None)], "item_id string, text string")


def whole(rows, columns):
    return sorted(map(repr, rows.select(*columns).collect()))


def test_filters_keep_all_columns(spark, plain, clashing, benchmark, tmp_path):
    stage = dict(importlib.import_module("corpus_pipeline").STAGES)["language_id"]
    for run in (
        neardup.dedupe,
        mixing.mixed,
        lambda docs: decontamination.clean(docs, benchmark),
        lambda docs: stage(spark, docs, ""),
    ):
        got = run(clashing)
        assert got.columns == clashing.columns
        assert whole(got, plain.columns) == whole(run(plain), plain.columns)
        for name in NAMES:
            same = got.filter(F.col(name) == F.concat_ws("-", F.lit(name), "doc_id"))
            assert same.count() == got.count()


def test_shards_keep_all_columns_but_their_own(plain, clashing):
    rows = sharding.with_shards(clashing, 5)
    own = ["size", "text_crc32", "shard"]
    assert set(rows.columns) == set(clashing.columns) | {"text_crc32"}
    assert whole(rows, [*plain.columns, *own]) == whole(sharding.with_shards(plain, 5), [*plain.columns, *own])
    kept = [n for n in NAMES if n not in own]
    assert whole(rows, kept) == whole(clashing, kept)
    assert rows.select("shard").distinct().count() == 5


def test_shards_of_text_ids(plain):
    rows = sharding.shard(plain, 4)
    assert rows.count() == len(ROWS)
    slots = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("slot").alias("m"))
    assert all(r.n == r.m + 1 for r in slots.collect())


def test_found_words_are_those_of_the_brute_force(clashing, benchmark):
    found = decontamination.find(clashing, benchmark)
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items) for r in found.collect()}
    items = [tuple(r) for r in benchmark.collect()]
    want = {r[:4] for r in brute.contamination([row[:2] for row in ROWS], items)}
    assert got == want
    assert {n for n in NAMES if n not in decontamination.ADDED} <= set(found.columns)
    hits = found.filter("contaminated").first()
    assert [tuple(x) for x in hits.hits] == [(5, 20)]


def seconds(run):
    start = time.time()
    run()
    return time.time() - start


def test_a_long_text_mostly_hit_takes_time_in_proportion(spark):
    words = [f"w{i % 5000}" for i in range(100_000)]
    item = spark.createDataFrame([("i", " ".join(words[:5000]))], "item_id string, text string")
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    rows = []
    took = seconds(lambda: rows.extend(decontamination.find(docs, item).collect()))
    # Windows over the end of the item into its beginning are not the item's.
    assert rows[0].n_words == 100_000 and rows[0].n_hit == 100_000
    assert len(rows[0].hits) == 1 and took < 60


def test_a_message_of_many_lines_takes_time_in_proportion(spark):
    text = "\n".join(f"{'> ' * (i // 3 % 3)}line {i}" for i in range(60_000))
    row = spark.createDataFrame([(text,)], "text string")
    found = []
    took = seconds(lambda: found.extend(row.select(conversations.passages(F.col("text")).alias("p")).first().p))
    assert len(found) == 20_000 and found[1].text == "line 3\nline 4\nline 5"
    assert took < 30


def test_no_documents_pass_all_stages(spark, plain):
    """Each stage by itself, on a table without rows but with the columns of documents."""
    docs = plain.withColumn("n_chars", F.length("text").cast("long")).filter("false")
    for name, stage in importlib.import_module("corpus_pipeline").STAGES:
        found = stage(spark, docs, "/root/testdata/sf0.001")
        assert found.count() == 0, name
        assert set(docs.columns) <= set(found.columns), name


def test_quality_of_no_documents(plain):
    labelled = plain.withColumn("quality", (F.length("doc_id") % 2).cast("int"))
    model = quality.fit(labelled, rounds=2)
    assert model is not None
    assert quality.score(plain.filter("false"), model).count() == 0
