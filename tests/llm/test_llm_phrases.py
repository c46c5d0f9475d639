"""Phrase mining against plain counting, by each of its ways, and the trie by itself."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardinel.llm import collocations, double_array

SCHEMA = "doc_id bigint, text string, lang string"


def mined(docs, least, longest=5, share=100, top=2000):
    totals, counts = Counter(), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            own = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(own)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(own[i : i + k])) for i in range(len(own) - k + 1))
    frequent = {key: f for key, f in counts.items() if f >= least and len(key[1]) > 1}
    rows = []
    for (lang, words), a in frequent.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        inside = any(
            x == lang and len(w) > len(words) and 100 * f >= share * a
            and any(w[i : i + len(words)] == words for i in range(len(w) - len(words) + 1))
            for (x, w), f in frequent.items()
        )
        if not inside:
            rows.append((lang, " ".join(words), a, left, right, totals[lang], score))
    out = []
    for lang in totals:
        own = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(lang, i + 1, *r[1:]) for i, r in enumerate(own[:top])]
    return sorted(out)


def corpus(seed):
    draw = random.Random(seed)
    words = ["a", "b", "C", "d", "é", "Ü", "x\x0e", "it's", "e f", "#", "1"]
    docs = [(0, None, "en"), (1, "", "en"), (2, "...", None), (3, "a b c d " * 3000, "hot")]
    for i in range(4, 120):
        text = ""
        for _ in range(draw.randint(0, 60)):
            text += draw.choice(["one two three four five six", *words[: draw.randint(1, len(words))]])
            text += draw.choice([" ", " ", "\t", "  ", ", ", "\n", "\x0b", ".", " . "])
        docs.append((i, text, draw.choice(["en", "de", None, "und"])))
    return docs


WAYS = {"trie": (10**6, 10**6), "overlaps": (10**6, 0), "shuffle": (0, 0), "late": (40, 400)}


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("least,share,top", [(12, 100, 2000), (5, 60, 7)])
def test_phrases_equal_plain_counting(spark, monkeypatch, way, least, share, top):
    docs = corpus(least)
    monkeypatch.setattr(collocations, "PHRASES", WAYS[way][0])
    monkeypatch.setattr(collocations, "CANDIDATES", WAYS[way][1])
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    for name in ("words", "f", "n", "key", "codes", "word", "piece"):
        df = df.withColumn(name, F.lit("mine"))
    got = collocations.mine(df, least, share=share, top=top)
    want = mined(docs, least, share=share, top=top)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 5


# Bounds for words, phrases, candidates and bits of a sieve.
LARGE = {
    "sieve": (10**6, 0, 0, 28),
    "sieve after candidates": (10**6, 60, 10**6, 28),
    "sieve between tries": (10**6, 90, 0, 28),
    "full sieve": (10**6, 0, 0, 0),
    "text": (0, 0, 0, 28),
}


@pytest.mark.parametrize("way", LARGE)
@pytest.mark.parametrize("least,share,top", [(12, 100, 2000), (3, 60, 7)])
def test_phrases_beyond_the_bounds_equal_plain_counting(spark, monkeypatch, way, least, share, top):
    docs, texts = corpus(least), []
    for name, bound in zip(("WORDS", "PHRASES", "CANDIDATES", "SIEVE_BITS"), LARGE[way], strict=True):
        monkeypatch.setattr(collocations, name, bound)
    if way == "full sieve":
        monkeypatch.setattr(collocations, "_sieve", lambda *_: collocations.Sieve(np.full(1, 255, np.uint8)))
    counted_as_text = collocations.shuffled
    monkeypatch.setattr(collocations, "shuffled", lambda *args: texts.append(args) or counted_as_text(*args))
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    got = collocations.mine(df, least, share=share, top=top)
    want = mined(docs, least, share=share, top=top)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 5
    assert bool(texts) == (way == "text")


def test_a_trie_has_no_more_digits_than_its_bound(spark, monkeypatch):
    monkeypatch.setattr(collocations, "DIGITS", 60)
    built, build = [], double_array.build
    monkeypatch.setattr(double_array, "build", lambda phrases, size: built.append(phrases.size) or build(phrases, size))
    docs = corpus(4)
    got = collocations.mine(spark.createDataFrame(docs, SCHEMA), 4)
    assert sorted(map(tuple, got.collect())) == mined(docs, 4)
    assert built and all(size <= 60 for size in built)


def test_many_frequent_phrases_are_not_shuffled_as_text(spark, monkeypatch):
    monkeypatch.setattr(collocations, "PHRASES", 5)
    docs = spark.createDataFrame(corpus(3), SCHEMA)
    monkeypatch.setattr(collocations, "shuffled", lambda *_: pytest.fail("all phrases as text"))
    phrases, _ = collocations.counted(docs, 3, 5)
    assert phrases.filter(F.size("words") == 2).count() > 5


@pytest.mark.parametrize("words", [1, 2, 3, 2**20, 2**21, 2**21 + 1, 2**31])
def test_packed_words_come_back(words):
    draw = np.random.default_rng(1)
    for length in range(1, 6):
        phrase = list(draw.integers(0, words, (length, 40)))
        phrase[0][0], phrase[-1][-1] = words - 1, words - 1
        keys = collocations.packed(phrase, words)
        assert all((key >= 0).all() for key in keys)
        assert np.array_equal(collocations.unpacked(keys, length, words), phrase)


def test_keys_of_one_hash_are_counted_apart(monkeypatch):
    monkeypatch.setattr(collocations, "_hashed", lambda columns: np.zeros(len(columns[0]), np.uint64))
    held = [[np.array([1, 2, 1]), np.array([5, 5, 5])], [np.array([2, 1]), np.array([5, 6])]]
    keys, n = collocations._grouped(held)
    totals = Counter()
    for a, b, count in zip(*keys, n, strict=True):
        totals[a, b] += count
    assert totals == {(1, 5): 2, (2, 5): 2, (1, 6): 1}


def test_no_documents(spark):
    assert collocations.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(1, "once only", "en")], SCHEMA)
    assert collocations.mine(one).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 10**13
    rows = [("en", ["x"], big), ("en", ["y"], big - 1), ("en", ["x", "y"], big - 7)]
    phrases = spark.createDataFrame(rows, "lang string, words array<string>, f long")
    totals = spark.createDataFrame([("en", 9 * big)], "lang string, n long")
    row = collocations.scored(phrases, totals).first()
    assert row.score == 1000 * (big - 7) * (9 * big) // (big * (big - 1))


def test_a_piece_longer_than_a_row_of_codes(spark, monkeypatch):
    monkeypatch.setattr(collocations, "ROW_CODES", 4)
    monkeypatch.setattr(collocations, "PASS_CODES", 8)
    monkeypatch.setattr(collocations, "HELD", 1)
    docs = corpus(1)
    texts = [(text, lang) for _, text, lang in docs]
    vocabulary = {}
    for text, lang in texts:
        vocabulary.setdefault(lang or "und", set())
    rows = collocations._rows(
        np.array([3, 4, 5, -1, 6, 7, 8, 9, 9, 2], np.int32), np.array([0, 0, 0, 0, 0, 1, 1, 1, 1, 2])
    )
    runs = " ".join(str(x) for row in rows for x in np.frombuffer(row, np.int32)).split("-1")
    assert [run.split() for run in runs if run.split()] == [["3", "4", "5"], ["7", "8", "9", "9"]]


@pytest.mark.parametrize("words,count,length", [(3, 5, 2), (70, 0, 2), (900, 700, 1), (5000, 4000, 3), (64, 4096, 2)])
def test_trie(words, count, length):
    draw = np.random.default_rng(words)
    phrases = np.unique((draw.zipf(1.3, (count, length)) - 1) % words, axis=0).astype(np.int64)
    phrases = phrases[draw.permutation(len(phrases))]
    trie = double_array.build(phrases, words)
    codes = (draw.zipf(1.3, 5000) - 1) % words
    codes[draw.random(5000) < 0.1] = -1
    numbers = {tuple(p): i for i, p in enumerate(phrases.tolist())}
    grams = [tuple(codes[i : i + length].tolist()) for i in range(5000 - length + 1)]
    want = [(i, numbers[g]) for i, g in enumerate(grams) if g in numbers]
    at, found = trie.accepted(codes)
    assert list(zip(at.tolist(), found.tolist(), strict=True)) == want


def test_candidates_have_frequent_parts():
    draw = random.Random(2)
    phrases = sorted({tuple(draw.choices(range(6), k=2)) for _ in range(20)})
    language = np.array([p[0] // 3 for p in phrases])
    got = collocations.candidates(np.array(phrases), language, 10**6)
    want = {
        (*p, q[1]) for p, x in zip(phrases, language, strict=True)
        for q, y in zip(phrases, language, strict=True) if p[1] == q[0] and x == y
    }
    assert {tuple(row) for row in got.tolist()} == want and len(got) == len(want)
    assert collocations.candidates(np.array(phrases), language, len(want) - 1) is None
