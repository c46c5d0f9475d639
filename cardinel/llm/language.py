"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text becomes a vector of hashed letter n-grams, weighted by rarity and scaled to
length one. Each language has several centroids, found by spherical k-means, and a
text goes to the language of the closest one. A text is rejected if it is much farther
from its centroid than nearly all training texts of its length are from centroids that
were found without them.
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
from cardinel.llm.text_arrays import pieces

BUCKETS_LOG2 = 12
BUCKETS = 1 << BUCKETS_LOG2
UNDETERMINED = "und"
# Limits are set for lengths of 1, 2, 4 ... n-grams. Texts weigh less the more their length
# differs: by a bell curve as wide as one doubling, or as it takes to reach so many texts.
LENGTHS = 24
NEAREST = 50
FOLDS = 4
PREDICTION = "lang_pred string, score double, rejected boolean"

# Letters only: capitals become small, other ASCII characters a space.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


@dataclass(frozen=True)
class Model:
    rarity: np.ndarray
    centroids: np.ndarray  # a row each
    languages: list[str]  # of the centroids
    least: np.ndarray  # similarity below which a text is rejected, by centroid and length


def counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts of hashed 2- and 3-byte grams of letters, a row for each text."""
    n = len(at) - 1
    if not len(data):
        return np.zeros((n, BUCKETS), np.float32)
    text = np.repeat(np.arange(n, dtype=np.int64), np.diff(at))
    folded = _FOLD[data]
    # Latin capitals with accents, whose second byte is 0x80 to 0x9E after 0xC3.
    accented = np.zeros(len(data), bool)
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    folded = folded.astype(np.uint32) + accented.astype(np.uint32) * np.uint32(32)
    total = np.zeros(n * BUCKETS, np.int64)
    grams = folded
    for size in (2, 3):
        if len(data) < size:
            break
        grams = grams[:-1] * np.uint32(256) + folded[size - 1 :]
        inside = text[: len(grams)] == text[size - 1 :]
        hashed = (grams * np.uint32(2654435761) + np.uint32(size)) >> np.uint32(32 - BUCKETS_LOG2)
        inside &= grams != np.uint32(0x202020 if size == 3 else 0x2020)
        own = text[: len(grams)][inside] * BUCKETS + hashed[inside]
        total += np.bincount(own, minlength=n * BUCKETS)
    return total.reshape(n, BUCKETS).astype(np.float32)


def unit(vectors: np.ndarray) -> np.ndarray:
    length = np.sqrt((vectors * vectors).sum(1, keepdims=True))
    return vectors / np.maximum(length, 1e-9)


def _weighted(frequencies: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    return unit(np.log1p(frequencies) * rarity)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, at in pieces(batch.column(1)):
            rows = [x.tobytes() for x in counts(data, at)]
            yield pa.record_batch(
                [batch.column(0)[row:end], pa.array(rows, pa.binary())], names=["lang", "vector"]
            )


def _clusters(vectors: np.ndarray, number: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means, begun with texts far apart from each other.

    A text of one letter has no n-grams. It is far from all others, itself included, and
    would be taken again and again; so such texts count only where there are no others.
    """
    some = vectors[vectors.any(1)]
    vectors = some if len(some) else vectors
    centres = vectors[:1]
    while len(centres) < min(number, len(vectors)):
        centres = np.vstack([centres, vectors[np.argmin((vectors @ centres.T).max(1))]])
    for _ in range(rounds):
        nearest = np.argmax(vectors @ centres.T, 1)
        sums = [vectors[nearest == k].sum(0) for k in range(len(centres))]
        centres = unit(np.array([s if s.any() else c for s, c in zip(sums, centres, strict=True)]))
    return centres


def _length(frequencies: np.ndarray) -> np.ndarray:
    """Number of n-grams as a power of two."""
    return np.minimum(np.log2(np.maximum(frequencies.sum(1), 1)), LENGTHS - 1)


def _held_out(vectors: np.ndarray, centroids: int) -> np.ndarray:
    """Similarity of each text to the nearest centroid of the other folds' texts."""
    fold = np.arange(len(vectors)) % FOLDS
    found = np.zeros(len(vectors))
    for k in range(min(FOLDS, len(vectors))):
        centres = _clusters(vectors[fold != k], centroids)
        found[fold == k] = (vectors[fold == k] @ centres.T).max(1)
    return found


def _limits(similar: np.ndarray, length: np.ndarray, low: float, slack: float) -> np.ndarray:
    """For each length, `slack` times the weighted quantile `low` of texts of like length."""
    out = np.zeros(LENGTHS)
    order = np.argsort(similar, kind="stable")
    similar, length = similar[order], length[order]
    for k in range(LENGTHS if len(similar) else 0):
        apart = np.abs(length - k)
        width = max(1.0, float(np.sort(apart)[min(NEAREST, len(apart)) - 1]))
        weight = np.cumsum(np.exp(-((apart / width) ** 2) / 2))
        out[k] = slack * similar[np.searchsorted(weight, low * weight[-1])]
    return out


def _fit(centroids: int, low: float, slack: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["lang", "vector"])
        frequencies = np.stack([np.frombuffer(x, np.float32) for x in rows["vector"]])
        rarity = np.log((1 + len(rows)) / (1 + (frequencies > 0).sum(0))) + 1
        rarity = rarity.astype(np.float32)
        vectors = _weighted(frequencies, rarity)
        length = _length(frequencies)
        out = [(None, rarity.tobytes(), None)]
        lone, similar = [], np.full(len(rows), np.nan)
        for language in rows["lang"].unique():
            mine = (rows["lang"] == language).to_numpy()
            # One text has none to be compared with: it gets the limits of all languages.
            lone += [language] if mine.sum() == 1 else []
            similar[mine] = np.nan if mine.sum() == 1 else _held_out(vectors[mine], centroids)
        known = ~np.isnan(similar)
        for language in rows["lang"].unique():
            mine = (rows["lang"] == language).to_numpy()
            texts = known if language in lone else mine
            least = _limits(similar[texts], length[texts], low, slack).tobytes()
            centres = _clusters(vectors[mine], centroids)
            out += [(language, c.astype(np.float32).tobytes(), least) for c in centres]
        return pd.DataFrame(out, columns=["lang", "vector", "least"])

    return run


def fit(
    docs: DataFrame, rows: int = 600, centroids: int = 4, low: float = 0.02, slack: float = 0.75
) -> Model | None:
    """Learn from the `text` of about `rows` rows of each `lang`; None without any.

    Rows without a language or a letter are not learned from.

    A text is rejected if its similarity is below `slack` times the quantile `low` of
    what training texts of the language and of like length have when they are held out.
    """
    known = docs.filter(F.col("text").rlike(r"\p{L}"))
    sample = sample_per_label(known, "lang", rows).select("lang", "text")
    vectors = sample.mapInArrow(_vectors, "lang string, vector binary")
    found = (
        vectors.groupBy()
        .applyInPandas(_fit(centroids, low, slack), "lang string, vector binary, least binary")
        .collect()
    )
    if not found:
        return None
    rarity = next(np.frombuffer(r["vector"], np.float32) for r in found if r["lang"] is None)
    own = [r for r in found if r["lang"] is not None]
    return Model(
        rarity,
        np.stack([np.frombuffer(r["vector"], np.float32) for r in own]),
        [r["lang"] for r in own],
        np.stack([np.frombuffer(r["least"]) for r in own]),
    )


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Adds `lang_pred`, `score` (cosine similarity, 0 to 1) and `rejected`.

    Columns of those names are replaced. A null text, and one without a letter, is
    `und` with score 0, and rejected; so is every text if there is no model.
    """
    added = T._parse_datatype_string(PREDICTION)
    rest = [c for c in docs.columns if c not in added.names]
    schema = T.StructType([*docs.select(*rest).schema, *added])
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    text_at = rest.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            best, score, least = np.zeros(n, np.int64), np.zeros(n), np.ones(n)
            for row, end, data, at in pieces(batch.column(text_at)) if model else ():
                frequencies = counts(data, at)
                near = _weighted(frequencies, model.rarity) @ model.centroids.T
                best[row:end] = near.argmax(1)
                score[row:end] = near.max(1)
                length = np.rint(_length(frequencies)).astype(np.int64)
                least[row:end] = model.least[best[row:end], length]
            clear = batch.column(len(rest)).to_numpy(zero_copy_only=False).astype(bool)
            clear &= model is not None
            names = np.array([*(model.languages if model else ()), UNDETERMINED], object)
            score = np.where(clear, np.clip(score, 0, 1), 0.0)
            rejected = ~clear | (score < least)
            columns = [names[np.where(clear, best, -1)], score, rejected]
            kinds = [pa.string(), pa.float64(), pa.bool_()]
            yield pa.record_batch(
                [*batch.columns[: len(rest)], *map(pa.array, columns, kinds)], names=schema.names
            )

    clash = "_lettered"
    while clash in rest:
        clash = "_" + clash
    return docs.select(*rest, lettered.alias(clash)).mapInArrow(run, schema)


def identify_held_out(docs: DataFrame, parts: int = 4, fold: int = 2) -> DataFrame:
    """Learn from all folds but one, predict every row; `held_out` marks that fold."""
    docs = docs.withColumn("held_out", crc(F.col("doc_id"), parts) == fold)
    model = fit(docs.filter(~F.col("held_out")))
    found = identify(docs.select("doc_id", "held_out", F.col("text").cast("string")), model)
    return found.drop("text")
