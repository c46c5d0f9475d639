"""Quality scores from a factorisation machine.

    score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

The features are hashed words, structure statistics of the text and numeric metadata.
The pairwise sum takes linear time, as half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2,
added up over the factors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardinel.llm.common import crc
from cardinel.llm.samples import sample_per_label
from cardinel.llm.text_arrays import IS_SPACE, pieces, sums_by, word_hashes, word_spans

# Rows of each label that are learned from, and rounds over them.
SAMPLE_ROWS, ROUNDS = 1200, 60
BUCKETS = 4096
FACTORS = 8
ADDED = "score double, predicted int"

_KINDS = {
    "capital": np.isin(np.arange(256), np.arange(65, 91)),
    "small": np.isin(np.arange(256), np.arange(97, 123)),
    "digit": np.isin(np.arange(256), np.arange(48, 58)),
    "bang": np.arange(256) == ord("!"),
    "bar": np.arange(256) == ord("|"),
    "symbol": np.isin(np.arange(256), [ord(c) for c in "#*$%&<>@^~=+_\\{}[]"]),
    "stop": np.isin(np.arange(256), [ord(c) for c in ".,;:?'\"()-"]),
    "line": np.arange(256) == 10,
    "high": np.arange(256) >= 128,
}


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray  # buckets first, then statistics and metadata
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word buckets with their text numbers, and a row of statistics a text."""
    n = len(at) - 1
    hashes, text = word_hashes(data, at)
    key = np.unique(text * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64))
    size = np.diff(at).astype(float)
    words = np.bincount(text, minlength=n).astype(float)
    some, letters = np.maximum(words, 1), np.maximum(size, 1)
    of_byte = np.repeat(np.arange(n), np.diff(at))
    kinds = {k: sums_by(t[data].astype(float), of_byte, n) for k, t in _KINDS.items()}
    order = np.lexsort((hashes, text))
    same = (hashes[order][1:] == hashes[order][:-1]) & (text[order][1:] == text[order][:-1])
    repeated = sums_by(same.astype(float), text[order][1:], n) if len(order) else np.zeros(n)
    run = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    runs = sums_by(run.astype(float), text[1:], n) if len(text) else np.zeros(n)
    start, end, _ = word_spans(data, at)
    long_words = sums_by((end - start > 20).astype(float), text, n)
    letter = np.maximum(kinds["capital"] + kinds["small"], 1)
    spaces = sums_by(IS_SPACE[data].astype(float), of_byte, n)
    stats = [
        np.log1p(size),
        np.log1p(words),
        (size - spaces) / some,
        kinds["capital"] / letter,
        np.log1p(kinds["bang"] / some * 20),
        np.log1p(kinds["bar"] / some * 20),
        np.log1p(kinds["symbol"] / some * 20),
        kinds["stop"] / some,
        kinds["digit"] / letters,
        kinds["high"] / letters,
        np.log1p(kinds["line"] / some * 20),
        repeated / some,
        np.log1p(runs / some * 20),
        long_words / some,
        kinds["capital"] / some,
    ]
    return key // BUCKETS, key % BUCKETS, np.stack(stats, 1)


def _extract(metadata: int):
    """Rows of label, word buckets and statistics, for fitting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            extra = _numbers(batch.columns[2 : 2 + metadata], batch.num_rows)
            for row, end, data, at in pieces(batch.column(1)):
                text, bucket, stats = features(data, at)
                cuts = np.searchsorted(text, np.arange(end - row + 1))
                buckets = [
                    bucket[i:j].astype(np.int32) for i, j in zip(cuts, cuts[1:], strict=False)
                ]
                stats = np.hstack([stats, extra[row:end]])
                yield pa.record_batch(
                    [
                        batch.column(0)[row:end],
                        pa.array([b.tobytes() for b in buckets], pa.binary()),
                        pa.array([s.tobytes() for s in stats], pa.binary()),
                    ],
                    names=["label", "buckets", "stats"],
                )

    return run


def _numbers(columns: list[pa.Array], n: int) -> np.ndarray:
    """Metadata as logarithms and whether it is missing."""
    out = []
    for column in columns:
        values = column.to_numpy(zero_copy_only=False).astype(float)
        out += [np.log1p(np.abs(np.nan_to_num(values))), np.isnan(values).astype(float)]
    return np.stack(out, 1) if out else np.zeros((n, 0))


def scaled(stats: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.clip((stats - mean) / spread, -5, 5)


def _fit(rounds: int, rate: float, decay: float):
    """All rows at once, by Adam; the gradient uses the same linear-time identity."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["label", "buckets", "stats"])
        y = rows["label"].to_numpy(float)
        raw = np.stack([np.frombuffer(x, float) for x in rows["stats"]])
        mean, spread = raw.mean(0), np.maximum(raw.std(0), 1e-3)
        stats = scaled(raw, mean, spread)
        lists = [np.frombuffer(x, np.int32) for x in rows["buckets"]]
        n, s = stats.shape
        size = np.array([len(x) for x in lists])
        row = np.repeat(np.arange(n), size)
        index = np.concatenate(lists).astype(np.int64)
        value = (1 / np.sqrt(np.maximum(size, 1)))[row]
        by_bucket = np.argsort(index, kind="stable")
        rng = np.random.default_rng(5)
        w = np.zeros(BUCKETS + s)
        v = rng.normal(0, 0.02, (BUCKETS + s, FACTORS))
        bias = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
        state = [np.zeros_like(x) for x in (w, w, v, v)]

        def by_row(x: np.ndarray) -> np.ndarray:
            return np.stack([np.bincount(row, c, n) for c in x.T], 1)

        def by_index(x: np.ndarray) -> np.ndarray:
            own = x[by_bucket]
            return np.stack([np.bincount(index[by_bucket], c, BUCKETS) for c in own.T], 1)

        for t in range(1, rounds + 1):
            vx = v[index] * value[:, None]
            total = by_row(vx) + stats @ v[BUCKETS:]
            squares = by_row(vx * vx) + (stats**2) @ (v[BUCKETS:] ** 2)
            linear = np.bincount(row, w[index] * value, n) + stats @ w[BUCKETS:]
            z = bias + linear + 0.5 * (total**2 - squares).sum(1)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
            inner = (total[row] - vx) * (value * error[row])[:, None]
            gw = np.r_[np.bincount(index, value * error[row], BUCKETS), stats.T @ error]
            own = (stats * error[:, None]).T @ total
            own -= v[BUCKETS:] * ((stats**2).T @ error)[:, None]
            gv = np.vstack([by_index(inner), own])
            bias -= rate * error.sum() * 10
            for k, (p, g) in enumerate(((w, gw), (v, gv))):
                g = g + decay * p
                m, q = state[2 * k], state[2 * k + 1]
                m += 0.1 * (g - m)
                q += 0.01 * (g * g - q)
                p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(q / (1 - 0.99**t)) + 1e-8)
        parts = [np.array([bias]), w, v.ravel(), mean, spread]
        return pd.DataFrame({"k": range(5), "data": [p.tobytes() for p in parts]})

    return run


def fit(
    docs: DataFrame,
    label: str = "quality",
    metadata: tuple[str, ...] = (),
    rows: int = SAMPLE_ROWS,
    rounds: int = ROUNDS,
) -> Model | None:
    """Learn from `text` and a 0/1 label of about `rows` rows of each label.

    `metadata` names numeric columns. None if no row has a label. The sample keeps the
    labels' own proportions up to its bound: rarer labels are taken whole.
    """
    known = docs.withColumn("_label", F.col(label).cast("int"))
    sample = sample_per_label(known, "_label", rows).select(
        "_label", F.col("text").cast("string"), *[F.col(c).cast("double") for c in metadata]
    )
    found = (
        sample.mapInArrow(_extract(len(metadata)), "label int, buckets binary, stats binary")
        .groupBy()
        .applyInPandas(_fit(rounds, 0.04, 1e-4), "k int, data binary")
        .collect()
    )
    if not found:
        return None
    parts = [np.frombuffer(r["data"], float) for r in sorted(found, key=lambda r: r["k"])]
    return Model(float(parts[0][0]), parts[1], parts[2].reshape(-1, FACTORS), parts[3], parts[4])


def _scores(model: Model, data: np.ndarray, at: np.ndarray, extra: np.ndarray) -> np.ndarray:
    n = len(at) - 1
    text, bucket, stats = features(data, at)
    stats = scaled(np.hstack([stats, extra]), model.mean, model.spread)
    size = np.bincount(text, minlength=n)
    value = (1 / np.sqrt(np.maximum(size, 1)))[text]
    z = model.bias + sums_by(model.weights[bucket] * value, text, n)
    z += stats @ model.weights[BUCKETS:]
    for f in range(FACTORS):
        v = model.factors[:, f]
        vx = v[bucket] * value
        total = sums_by(vx, text, n) + stats @ v[BUCKETS:]
        squares = sums_by(vx * vx, text, n) + (stats**2) @ (v[BUCKETS:] ** 2)
        z += 0.5 * (total**2 - squares)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(
    docs: DataFrame,
    model: Model | None,
    metadata: tuple[str, ...] = (),
    threshold: float = 0.7,
) -> DataFrame:
    """Adds `score` (0 to 1) and `predicted` (1 from the threshold on).

    Columns of those names are replaced. Null texts count as empty; without a model
    all rows score 0.
    """
    added = T._parse_datatype_string(ADDED)
    rest = [c for c in docs.columns if c not in added.names]
    schema = T.StructType([*docs.select(*rest).schema, *added])
    taken = [F.col("text").cast("string"), *[F.col(c).cast("double") for c in metadata]]
    names = [f"_in{i}_{'_'.join(rest)}" for i in range(len(taken))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = len(rest)
            extra = _numbers(batch.columns[k + 1 :], batch.num_rows)
            out = np.zeros(batch.num_rows)
            for row, end, data, at in pieces(batch.column(k)) if model else ():
                out[row:end] = _scores(model, data, at, extra[row:end])
            predicted = (out >= threshold).astype(np.int32)
            yield pa.record_batch(
                [*batch.columns[:k], pa.array(out), pa.array(predicted)], names=schema.names
            )

    renamed = [c.alias(name) for c, name in zip(taken, names, strict=True)]
    return docs.select(*rest, *renamed).mapInArrow(run, schema)


def score_held_out(
    docs: DataFrame,
    labels: DataFrame,
    parts: int = 4,
    fold: int = 2,
    rows: int = SAMPLE_ROWS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Learn from labelled rows of all folds but one, score every row."""
    docs = docs.select(
        "doc_id",
        (crc(F.col("doc_id"), parts) == fold).alias("held_out"),
        F.col("text").cast("string"),
        F.col("n_chars").cast("double").alias("n_chars"),
    )
    metadata = ("n_chars",)
    own = labels.filter(crc(F.col("doc_id"), parts) != fold)
    chosen = sample_per_label(own.select("doc_id", "quality"), "quality", rows)
    # The sample is bounded, so that its ids can go to every scan.
    training = docs.filter(~F.col("held_out")).join(F.broadcast(chosen), "doc_id")
    model = fit(training, "quality", metadata, rows, rounds)
    return score(docs, model, metadata).drop("text", "n_chars")
