"""Connected components against union-find, and how much of the links is gone over again."""

from __future__ import annotations

import random

import brute
import pytest

from cardinel.llm import components, neardup


def brute_components(links):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return {(x, root(x)) for x in up if root(x) != x}


def found(spark, links):
    table = spark.createDataFrame(links, "a long, b long").repartition(3).cache()
    rows = components.components(table).collect()
    assert len(rows) == len({row.node for row in rows})
    return {(row.node, row.component) for row in rows}


def test_components(spark):
    draw = random.Random(5)
    chain = draw.sample(range(1000), 60)
    loose = [(draw.randrange(2000, 2120), draw.randrange(2000, 2120)) for _ in range(70)]
    links = [*zip(chain, chain[1:], strict=False), *loose, *loose[:20], (3000, 3000), (3001, 3002)]
    links += [(3100, n) for n in (3050, 3060, 3150, 3160)]
    assert found(spark, links) == brute_components(links)
    assert found(spark, []) == found(spark, [(1, 1)]) == set()


@pytest.fixture
def tables(monkeypatch):
    """Names of the tables that components are made of."""
    names = []

    def saved(df, name, keep=components.saved):
        names.append(name)
        return keep(df, name)

    monkeypatch.setattr(components, "saved", saved)
    return names


def test_stars_take_one_round(spark, tables):
    links = [(50, n) for n in (10, 20, 70, 80)] + [(5, n) for n in (6, 7)]
    assert found(spark, links) == brute_components(links)
    assert tables == ["large-stars", "small-stars"]


def test_links_of_later_steps_are_merged_alone(spark, monkeypatch):
    draw, rows = random.Random(3), []
    for family in range(8):
        for k in range(25):
            words = [f"f{family}x{i}" for i in range(40)]
            for i in draw.sample(range(40), draw.randint(1, 3)):
                words[i] += "y"
            rows.append((100 * family + k, " ".join(words)))
    given, merged = [], neardup.components

    def counted(links):
        given.append(links.count())
        return merged(links)

    monkeypatch.setattr(neardup, "components", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.group(df, size=3, percent=85).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect())) == sorted(brute.near_groups(rows, 3, 85))
    assert len(given) > 1 and sum(given[1:]) < given[0]
