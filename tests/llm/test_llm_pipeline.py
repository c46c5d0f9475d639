"""The stages after each other, each against a brute-force version of its decision."""

import importlib

import brute
import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages():
    return importlib.import_module("corpus_pipeline").STAGES


def test_stages(spark, stages):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    by_name = dict(stages)
    assert list(by_name) == [
        "language_id", "near_dedup", "decontamination", "source_mixing", "sharding"
    ]

    def run(name, rows):
        found = by_name[name](spark, rows, FOLDER).cache()
        if name != "sharding":
            assert found.columns == docs.columns
        return found

    def texts(rows):
        return [(r.doc_id, r.text) for r in rows.collect()]

    clear = run("language_id", docs)
    assert clear.count() >= 0.98 * docs.count()
    unique = run("near_dedup", clear)
    groups = {c for _, _, c in brute.near_groups(texts(clear), 5, 80)}
    assert sorted(d for d, _ in texts(unique)) == sorted(groups)
    clean = run("decontamination", unique)
    hit = {d for d, _, n, _, _ in brute.contamination(texts(unique), items) if n}
    assert {d for d, _ in texts(clean)} == {d for d, _ in texts(unique)} - hit
    mixed = run("source_mixing", clean)
    size = {}
    for r in clean.collect():
        size[r.source] = size.get(r.source, 0) + len(brute.words(r.text))
    taken = {}
    for r in mixed.collect():
        taken[r.source] = taken.get(r.source, 0) + len(brute.words(r.text))
    longest = max(len(brute.words(t)) for _, t in texts(clean))
    for source, goal in brute.targets(size).items():
        assert abs(taken.get(source, 0) - goal) <= longest
    sharded = run("sharding", mixed)
    assert sharded.count() == mixed.count()
    assert sharded.filter("shard < 0 or shard > 39").count() == 0


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert {"pipeline", *[f"op{n}" for n in range(1, 11)]} <= {
        name.split("_")[0] if name.startswith("op") else name for name in names
    }
