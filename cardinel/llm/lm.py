"""Language model scoring: interpolated modified Kneser-Ney over word bigrams.

Counts are gathered by Spark in three shuffles of sorted, packed arrays: words,
bigrams, and the statistics of contexts and continuations that the bigrams imply.
Each reducer writes its part of the model as sorted hash arrays into the shared
work folder; scoring workers map those files into memory and look whole batches up
by binary search, so a worker's memory does not grow with the model.

Rows of the shuffles are packed arrays, not single n-grams: a task adds equal
n-grams up before it sends them, and an n-gram takes a few bytes instead of a row.

The shared folder (`spark.checkpoint.dir`) must be one that executors can open as
files, such as a mounted volume; memory mapping needs that.
"""

from __future__ import annotations


import os
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardinel.llm.common import crc
from cardinel.llm.text_arrays import mix, pieces, sums_by, word_hashes
from cardinel.session import work_folder

END, BEGIN = np.uint64(1), np.uint64(2)
# Ids take 32 bits; the largest is that of words the model has not seen.
UNSEEN = np.uint32(0xFFFFFFFF)
MOST_PARTS = 4096

PACKED = "part int, n long, a binary, b binary"
SCORES = (
    "n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


@dataclass(frozen=True)
class Model:
    """Where the parts are, and the few numbers that hold for the whole model."""

    folder: str
    parts: int
    starts: tuple[int, ...]  # id of the first word of each part
    tokens: int
    words: int
    bigram_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    bigram_types: int
    continued: tuple[int, int, int]  # words with one, two, and more left neighbours


def planes(values: np.ndarray) -> bytes:
    """Byte planes of a sorted array's differences, which compress well."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return steps.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unplaned(data: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    flat = np.frombuffer(data, np.uint8).reshape(size, -1).T.copy()
    return np.cumsum(flat.view(dtype).ravel(), dtype=dtype)


def plain(values: np.ndarray) -> bytes:
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unplain(data: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(dtype).ravel()


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else order
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Parts are ranges of hashes, so that parts in order are in hash order."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    part, n, a, b = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.record_batch(
        [
            pa.array(part, pa.int32()),
            pa.array(n, pa.int64()),
            pa.array(a, pa.binary()),
            pa.array(b, pa.binary()),
        ],
        names=["part", "n", "a", "b"],
    )


def _tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, token hashes and text numbers; each text ends with END."""
    for row, end, data, at in pieces(column):
        hashes, text = word_hashes(data, at)
        n = end - row
        counts = np.bincount(text, minlength=n)
        ends = np.cumsum(counts + 1) - 1
        tokens = np.full(len(hashes) + n, END, np.uint64)
        where = np.ones(len(tokens), bool)
        where[ends] = False
        tokens[where] = hashes
        yield row, end, tokens, np.repeat(np.arange(n), counts + 1)


def _count_words(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(t, return_counts=True) for _, _, t, _ in _tokens(batch.column(0))]
            if not found:
                continue
            keys = np.concatenate([np.array([BEGIN]), *[k for k, _ in found]])
            counts = np.concatenate([np.zeros(1, np.int64), *[c for _, c in found]])
            keys, counts = _summed(keys, counts)
            cuts = np.searchsorted(_part(keys, parts), np.arange(parts + 1))
            rows = []
            for p in range(parts):
                i, j = cuts[p], cuts[p + 1]
                if j > i:
                    rows.append((p, j - i, planes(keys[i:j]), plain(counts[i:j])))
            yield _packed(rows)

    return run


def _store(path: str, array: np.ndarray) -> None:
    """Whole or not at all, and the same again if a task is repeated."""
    own = f"{path}.{os.getpid()}.{np.random.default_rng().integers(1 << 60)}"
    array.tofile(own)
    os.replace(own, path)


def _merge_words(folder: str):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        part = int(key[0])
        keys = np.concatenate([unplaned(x, np.uint64) for x in rows["a"]])
        counts = np.concatenate([unplain(x, np.int64) for x in rows["b"]])
        keys, counts = _summed(keys, counts)
        _store(f"{folder}/words-{part}", keys)
        _store(f"{folder}/counts-{part}", counts)
        return pd.DataFrame(
            {"part": [part], "n": [len(keys)], "known": [int((counts > 0).sum())],
             "total": [int(counts.sum())]}
        )

    return run


class Store:
    """The parts of a model, mapped into memory when first asked for."""

    def __init__(self, folder: str, parts: int, starts: tuple[int, ...]):
        self.folder, self.parts, self.starts = folder, parts, starts
        self.open: dict[str, np.ndarray] = {}

    def array(self, name: str, part: int, dtype: type) -> np.ndarray:
        path = f"{self.folder}/{name}-{part}"
        if path not in self.open:
            some = os.path.exists(path) and os.path.getsize(path)
            self.open[path] = np.memmap(path, dtype, "r") if some else np.zeros(0, dtype)
        return self.open[path]

    def find(self, hashes: np.ndarray, name: str, *others: tuple[str, type]) -> list[np.ndarray]:
        """For sorted hashes: their places in the parts, or -1, and the values there."""
        place = np.full(len(hashes), -1, np.int64)
        values = [np.zeros(len(hashes), kind) for _, kind in others]
        cuts = np.searchsorted(_part(hashes, self.parts), np.arange(self.parts + 1))
        for p in range(self.parts):
            i, j = cuts[p], cuts[p + 1]
            keys = self.array(name, p, np.uint64)
            if j == i or not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, hashes[i:j]), len(keys) - 1)
            hit = keys[at] == hashes[i:j]
            place[i:j][hit] = at[hit] + (self.starts[p] if self.starts else 0)
            for out, (other, kind) in zip(values, others, strict=True):
                out[i:j][hit] = self.array(other, p, kind)[at[hit]]
        return [place, *values]


def _ids(store: Store, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens, their ids, and which of them each token is."""
    distinct, which = np.unique(tokens, return_inverse=True)
    place = store.find(distinct, "words")[0]
    return distinct, np.where(place < 0, np.int64(UNSEEN), place).astype(np.uint32), which


def _previous(ids: np.ndarray, text: np.ndarray, begin: np.uint32) -> np.ndarray:
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[np.r_[True, text[1:] != text[:-1]]] = begin
    return before


def _begin_id(store: Store) -> np.uint32:
    return np.uint32(store.find(np.array([BEGIN]), "words")[0][0])


def _pairs(before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return (before.astype(np.uint64) << np.uint64(32)) | ids


def _count_bigrams(folder: str, parts: int, starts: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(folder, parts, starts)
        for batch in batches:
            found = []
            for _, _, tokens, text in _tokens(batch.column(0)):
                _, ids, which = _ids(store, tokens)
                ids = ids[which]
                pairs = _pairs(_previous(ids, text, _begin_id(store)), ids)
                found.append(np.unique(pairs, return_counts=True))
            if not found:
                continue
            keys, counts = _summed(
                np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found])
            )
            part = _part(mix(keys), parts)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            rows = []
            for p in range(parts):
                if cuts[p + 1] > cuts[p]:
                    own = order[cuts[p] : cuts[p + 1]]
                    rows.append((p, len(own), planes(keys[own]), plain(counts[own])))
            yield _packed(rows)

    return run


def _merge_bigrams(folder: str, parts: int, starts: tuple[int, ...]):
    """Stores a part of the bigrams; returns what they say of contexts and continuations.

    Statistics go to the part of the word they are about. `b` holds six columns:
    continuations of the word, then, as context, its tokens and its bigrams seen
    once, twice and more often. Part -1 has the counts of counts.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        part = int(key[0])
        keys = np.concatenate([unplaned(x, np.uint64) for x in rows["a"]])
        counts = np.concatenate([unplain(x, np.int64) for x in rows["b"]])
        keys, counts = _summed(keys, counts)
        hashes = mix(keys)
        order = np.argsort(hashes)
        _store(f"{folder}/bigrams-{part}", hashes[order])
        _store(f"{folder}/bigram_counts-{part}", counts[order])
        ids = np.concatenate([keys & np.uint64(UNSEEN), keys >> np.uint64(32)]).astype(np.uint32)
        zero, one = np.zeros(len(keys), np.int64), np.ones(len(keys), np.int64)
        stats = np.stack(
            [np.r_[one, zero], np.r_[zero, counts]]
            + [np.r_[zero, x] for x in (counts == 1, counts == 2, counts > 2)], 1
        )
        order = np.argsort(ids, kind="stable")
        ids, stats = ids[order], stats[order]
        first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        ids, stats = ids[first], np.add.reduceat(stats, first, axis=0)
        cuts = np.searchsorted(ids, np.array([*starts, 1 << 32]))
        out = [(-1, len(keys), np.bincount(np.minimum(counts, 5), minlength=6).tobytes(), b"")]
        for p in range(parts):
            i, j = cuts[p], cuts[p + 1]
            if j > i:
                flat = np.ascontiguousarray(stats[i:j].T).ravel()
                out.append((p, j - i, planes(ids[i:j]), plain(flat)))
        return pd.DataFrame(out, columns=["part", "n", "a", "b"])

    return run


def _merge_stats(folder: str, starts: tuple[int, ...]):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        part = int(key[0])
        if part < 0:
            total = sum(np.frombuffer(x, np.int64) for x in rows["a"])
            return pd.DataFrame({"part": [part], "n": [int(rows["n"].sum())],
                                 "counts": [[int(x) for x in total]]})
        words = os.path.getsize(f"{folder}/words-{part}") // 8
        stats = np.zeros((words, 5), np.int64)
        for a, b in zip(rows["a"], rows["b"], strict=True):
            ids = unplaned(a, np.uint32).astype(np.int64) - starts[part]
            stats[ids] += unplain(b, np.int64).reshape(5, -1).T
        _store(f"{folder}/continued-{part}", np.ascontiguousarray(stats[:, 0]))
        _store(f"{folder}/context-{part}", np.ascontiguousarray(stats[:, 1:]).ravel())
        seen = np.bincount(np.minimum(stats[:, 0], 5), minlength=6)
        return pd.DataFrame({"part": [part], "n": [words], "counts": [[int(x) for x in seen]]})

    return run


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many n-grams occur 1, 2, 3 and 4 times.

    Where a count that is divided by is zero (tiny corpora), the discount is 0.5.
    """
    n1, n2, n3, n4 = counts[1:5]
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    found = []
    for i, (low, high) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        value = i - (i + 1) * y * high / low if low else 0.5
        found.append(min(max(value, 0.05), i - 0.05))
    return tuple(found)


def shared_path(spark, name: str) -> str:
    """A new folder that workers can open as files."""
    url = urlparse(work_folder(spark, name))
    if url.scheme not in ("", "file"):
        raise ValueError("memory mapping needs spark.checkpoint.dir on a mounted file system")
    os.makedirs(url.path, exist_ok=True)
    return url.path


def fit(docs: DataFrame, parts: int | None = None) -> Model:
    """Learn from the `text` of all rows; null and empty texts are a lone end token.

    `parts` is into how many files the model is split: twice the scan's tasks if not
    given, 16 at least and 4096 at most.
    """
    spark = docs.sparkSession
    text = docs.select(F.col("text").cast("string"))
    if parts is None:
        parts = min(max(16, 2 * text.rdd.getNumPartitions()), MOST_PARTS)
    folder = shared_path(spark, "bigram-model")
    kept = "part int, n long, known long, total long"
    words = text.mapInArrow(_count_words(parts), PACKED).repartition(parts, "part")
    words = words.groupBy("part").applyInPandas(_merge_words(folder), kept).collect()
    sizes = np.zeros(parts, np.int64)
    for row in words:
        sizes[row["part"]] = row["n"]
    if sizes.sum() >= int(UNSEEN):
        raise ValueError("more than 2^32 distinct words")
    starts = tuple(int(x) for x in np.cumsum(sizes) - sizes)
    pairs = text.mapInArrow(_count_bigrams(folder, parts, starts), PACKED)
    stats = (
        pairs.repartition(parts, "part")
        .groupBy("part")
        .applyInPandas(_merge_bigrams(folder, parts, starts), PACKED)
        .repartition(parts, "part")
        .groupBy("part")
        .applyInPandas(_merge_stats(folder, starts), "part int, n long, counts array<long>")
        .collect()
    )
    bigrams, continued, types = [0] * 6, [0] * 6, 0
    for row in stats:
        if row["part"] < 0:
            bigrams, types = row["counts"], row["n"]
        else:
            continued = [x + y for x, y in zip(continued, row["counts"], strict=True)]
    return Model(
        folder,
        parts,
        starts,
        sum(r["total"] for r in words),
        sum(r["known"] for r in words),
        discounts(bigrams),
        discounts(continued),
        types,
        (continued[1], continued[2], sum(continued[3:])),
    )


def _spread(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *by])[np.minimum(counts, 3)]


def _score_piece(model: Model, store: Store, tokens: np.ndarray, text: np.ndarray, n: int):
    distinct, ids, which = _ids(store, tokens)
    place, counts, continued = store.find(
        distinct, "words", ("counts", np.int64), ("continued", np.int64)
    )
    base = np.log10((counts + 1) / (model.tokens + model.words + 1))
    # Words: discounted continuation counts, interpolated with a uniform distribution
    # over the known words and one unseen word.
    left = sum(d * c for d, c in zip(model.word_discounts, model.continued, strict=True))
    total = max(model.bigram_types, 1)
    left = left / total if model.bigram_types else 1.0
    lower = np.maximum(continued - _spread(continued, model.word_discounts), 0) / total
    lower = lower + left / (model.words + 1)
    # Bigrams: discounted counts, interpolated with the words.
    tokens_ids = ids[which]
    before = _previous(tokens_ids, text, _begin_id(store))
    pairs, where = np.unique(_pairs(before, tokens_ids), return_inverse=True)
    hashes = mix(pairs)
    order = np.argsort(hashes)
    found = np.zeros(len(pairs), np.int64)
    found[order] = store.find(hashes[order], "bigrams", ("bigram_counts", np.int64))[1]
    contexts, context = np.unique(before, return_inverse=True)
    stats = _contexts(store, contexts)
    seen = np.maximum(stats[:, 0], 1)
    back = np.where(stats[:, 0] > 0, stats[:, 1:] @ np.array(model.bigram_discounts) / seen, 1.0)
    c = found[where]
    higher = np.maximum(c - _spread(c, model.bigram_discounts), 0) / seen[context]
    score = np.log10(higher + back[context] * lower[which])
    known = counts[which] > 0
    return (
        np.bincount(text, minlength=n),
        sums_by(known.astype(float), text, n).astype(np.int64),
        sums_by(base[which], text, n),
        sums_by(score, text, n),
    )


def _contexts(store: Store, ids: np.ndarray) -> np.ndarray:
    stats = np.zeros((len(ids), 4), np.int64)
    cuts = np.searchsorted(ids, np.array([*store.starts, int(UNSEEN)]))
    for p in range(store.parts):
        i, j = cuts[p], cuts[p + 1]
        if j > i:
            own = store.array("context", p, np.int64).reshape(-1, 4)
            stats[i:j] = own[ids[i:j].astype(np.int64) - store.starts[p]]
    return stats


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Log10 probability of each row's `text` under the model, and under add-one words.

    Keeps the columns but `text`, and adds `n_tokens`, `n_known`, `train_tokens`,
    `base_score`, `score` and `perplexity`; columns of those names are replaced.
    Null and empty texts are a lone end token.
    """
    added = T._parse_datatype_string(f"{SCORES}, perplexity double")
    rest = [c for c in docs.columns if c not in {"text", *added.names}]
    schema = T.StructType([*docs.select(*rest).schema, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(model.folder, model.parts, model.starts)
        for batch in batches:
            n = batch.num_rows
            tokens, known = np.zeros(n, np.int64), np.zeros(n, np.int64)
            base, own = np.zeros(n), np.zeros(n)
            for row, end, hashes, text in _tokens(batch.column(len(rest))):
                found = _score_piece(model, store, hashes, text, end - row)
                for out, values in zip((tokens, known, base, own), found, strict=True):
                    out[row:end] = values
            train = np.full(n, model.tokens, np.int64)
            with np.errstate(over="ignore"):
                perplexity = np.power(10.0, -own / np.maximum(tokens, 1))
            columns = [tokens, known, train, base, own, perplexity]
            yield pa.record_batch(
                [*batch.columns[: len(rest)], *map(pa.array, columns)], names=schema.names
            )

    return docs.select(*rest, F.col("text").cast("string")).mapInArrow(run, schema)


def score_held_out(docs: DataFrame, parts: int = 7, fold: int = 2) -> DataFrame:
    """Learn from all folds but one, score every row; `held_out` marks that fold."""
    docs = docs.withColumn("held_out", crc(F.col("doc_id"), parts) == fold)
    model = fit(docs.filter(~F.col("held_out")))
    return score(docs.select("doc_id", "held_out", "text"), model)


