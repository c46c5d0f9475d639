"""Every registered query against SQL in another engine, row by row."""

import importlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest

entry = importlib.import_module("__spark_entry__")

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def rows(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(
        tuple((type(row[i]), row[i]) for i in order) for row in tuples
    )


def test_every_query_has_sql():
    from testbed import registry

    assert set(registry.QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query_matches_sql(spark, duck, name):
    result = entry.queries()[name](spark, FOLDER)
    got = rows(result.columns, [tuple(row) for row in result.collect()])
    answer = duck.execute(entry.oracle_sql()[name])
    names = [column[0] for column in answer.description]
    assert sorted(result.columns) == sorted(names)
    want = rows(names, answer.fetchall())
    assert sum(want.values()) > 0
    missing, extra = list((want - got).items())[:3], list((got - want).items())[:3]
    assert got == want, f"missing {missing}\nextra {extra}"


def test_entry(spark):
    assert entry.entry(spark).count() > 0
