"""Exact duplicate substrings by prefix doubling over sampled positions.

A byte goes if it lies in a string of 200 bytes that starts elsewhere too. Doubling
from every position would sort a row for each byte in every round. Here the rounds run
over fewer positions, without losing any:

1. Rank of 100 bytes. Each window of 200 bytes is placed at one position in it, its
   anchor: the start of the 100 bytes of smallest hash. Equal windows have equal
   anchors, and neighbouring windows share theirs, so there is one anchor to some 50
   bytes. Anchors are ranked by their 100 bytes; the windows of unique ones are unique.
2. Past the threshold at once. The windows of an anchor form a block of 200 bytes or
   more. Blocks are ranked by their bytes; all windows of a block that occurs twice
   are duplicates. This settles the inside of every long copy.
3. Doubling at the rims. Where an anchor has different blocks, each different block
   is ranked once, at every window's start: pairs of the rank of 100 bytes and the rank
   at offset 100 make the rank of 200 bytes, and starts with a unique one are dropped.

Ranks are 64-bit hashes of the bytes (see `text_arrays`), so that Spark's grouping
takes the place of sorting them into numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardinel.llm.common import saved
from cardinel.llm.text_arrays import BASE, mix, pieces, running, span_hash

LENGTH = 200
GRAM = 100
RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _anchors(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For each block: text number, first and last window start, and anchor."""
    n = len(data)
    if n < length:
        return (np.zeros(0, np.int64),) * 4
    sums = running(data)
    start = np.arange(n - GRAM + 1)
    grams = span_hash(sums, start, start + GRAM)
    # Hash above, place below: a minimum is the leftmost of the smallest hashes.
    keys = (grams & np.uint64(0xFFFFFFFF00000000)) | start.astype(np.uint64)
    width = length - GRAM + 1
    rows = -(-len(keys) // width)
    padded = np.full(rows * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(keys)] = keys
    grid = padded.reshape(rows, width)
    forward = np.minimum.accumulate(grid, 1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(backward[: n - length + 1], forward[width - 1 : n - length + width])
    size = np.diff(at)
    text = np.repeat(np.arange(len(size)), size)[: len(least)]
    window = np.flatnonzero(np.arange(len(least)) + length <= at[1:][text])
    anchor = (least[window] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = text[window]
    if not len(window):
        return (np.zeros(0, np.int64),) * 4
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
    last = np.r_[new[1:], len(window)] - 1
    return text[new], window[new], window[last], anchor[new]


BLOCKS = "rid long, first int, last int, gram long, block long"


def _blocks(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, at in pieces(batch.column(1)):
                text, first, last, anchor = _anchors(data, at, length)
                if not len(text):
                    continue
                sums = running(data)
                gram = span_hash(sums, anchor, anchor + GRAM)
                block = span_hash(sums, first, last + length)
                block = block * np.uint64(2) + (anchor - first).astype(np.uint64)
                rid = batch.column(0)[row:end].take(pa.array(text))
                columns = [
                    rid,
                    pa.array((first - at[text]).astype(np.int32)),
                    pa.array((last - at[text]).astype(np.int32)),
                    pa.array(gram.view(np.int64)),
                    pa.array(block.view(np.int64)),
                ]
                names = ["rid", "first", "last", "gram", "block"]
                yield pa.record_batch(columns, names=names)

    return run


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and bounds of a list column; a null list is empty."""
    size = column.value_lengths().fill_null(0).to_numpy()
    return column.flatten(), np.r_[0, np.cumsum(size)]


def _ranks(length: int):
    """A row for each window of a text's blocks: the rank of its halves' pair of ranks."""
    half = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, bounds = _lists(batch.column(2))
            first, last, once = (spans.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            for row, end, data, at in pieces(batch.column(1)):
                sums = running(data)
                i, j = bounds[row], bounds[end]
                text = np.repeat(np.arange(end - row), np.diff(bounds[row : end + 1]))
                size = last[i:j] - first[i:j] + 1
                block = np.repeat(np.arange(j - i), size)
                step = np.arange(len(block)) - np.repeat(np.cumsum(size) - size, size)
                start = at[text][block] + first[i:j][block] + step
                rank = span_hash(sums, start, start + half)
                rank = mix(rank * BASE + span_hash(sums, start + half, start + length))
                columns = [
                    batch.column(0)[row:end].take(pa.array(text[block])),
                    pa.array((start - at[text][block]).astype(np.int32)),
                    pa.array(once[i:j][block].astype(bool)),
                    pa.array(rank.view(np.int64)),
                ]
                yield pa.record_batch(columns, names=["rid", "start", "once", "rank"])

    return run


def _removed(length: int, names: list[str], keep_text: bool):
    """Cuts the blocks and windows out of each text."""
    k = len(names) - 4 - keep_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            spans, bounds = _lists(batch.column(k + 1))
            first, last = (spans.field(i).to_numpy(zero_copy_only=False) for i in range(2))
            size, gone, runs = (np.zeros(n, np.int64) for _ in range(3))
            digest, left = [], []
            for row, end, data, at in pieces(batch.column(k)):
                text = np.repeat(np.arange(end - row), np.diff(bounds[row : end + 1]))
                i, j = bounds[row], bounds[end]
                edges = np.zeros(len(data) + 1, np.int64)
                np.add.at(edges, at[text] + first[i:j], 1)
                np.add.at(edges, at[text] + last[i:j] + length, -1)
                covered = np.cumsum(edges)[:-1] > 0
                for r in range(row, end):
                    own = slice(at[r - row], at[r - row + 1])
                    out = covered[own]
                    rest = data[own][~out].tobytes() if len(out) else b""
                    size[r], gone[r] = len(out), out.sum()
                    runs[r] = out[:1].sum() + (out[1:] & ~out[:-1]).sum()
                    digest.append(hashlib.sha256(rest).hexdigest())
                    if keep_text:
                        left.append(rest)
            columns = [*map(pa.array, (size, gone, runs)), pa.array(digest, pa.string())]
            if keep_text:
                columns.append(pa.array(left, pa.binary()))
            yield pa.record_batch([*batch.columns[:k], *columns], names=names)

    return run


def find(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The blocks and windows of each text that are duplicates: rid and spans of starts."""
    rows = docs.select(F.xxhash64("doc_id", "text").alias("rid"), F.col("text").cast("string"))
    blocks = saved(rows.mapInArrow(_blocks(length), BLOCKS), "substring-blocks")
    grams = blocks.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    grams = saved(grams, "substring-grams")
    again = saved(blocks.join(grams, "gram"), "substring-anchors")
    kinds = again.groupBy("gram", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "first", "last")).alias("one")
    )
    kinds = saved(kinds, "substring-kinds")
    whole = again.join(kinds.filter("n > 1").select("gram", "block"), ["gram", "block"])
    whole = whole.select("rid", "first", "last")
    mixed = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("_k"), F.min("n").alias("_n"))
    mixed = mixed.filter("_k > 1 and _n = 1").select("gram")
    open_ = kinds.join(mixed, "gram").select("one.*", (F.col("n") == 1).alias("once"))
    open_ = open_.groupBy("rid").agg(
        F.collect_list(F.struct("first", "last", "once")).alias("spans")
    )
    schema = "rid long, start int, once boolean, rank long"
    texts = rows.join(open_, "rid").select("rid", "text", "spans")
    starts = saved(texts.mapInArrow(_ranks(length), schema), "substring-ranks")
    twice = starts.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    twice = saved(twice.select("rank"), "substring-again")
    rims = starts.filter("once").join(twice, "rank")
    rims = rims.select("rid", F.col("start").alias("first"), F.col("start").alias("last"))
    both = whole.union(rims).groupBy("rid").agg(
        F.sort_array(F.collect_set(F.struct("first", "last"))).alias("spans")
    )
    return saved(both, "substring-spans")


def remove(docs: DataFrame, length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """`n_bytes`, `n_removed`, `n_spans` and `kept_sha256` for rows of doc_id and text.

    Texts are UTF-8 bytes; null is empty. Every byte goes that is covered by a string of
    `length` bytes which starts anywhere else too, in the input. With `keep_text` what
    is left comes as `kept`, as bytes, since a cut may fall within a character.
    """
    spans = find(docs, length)
    names = ["doc_id", *RESULT.replace(" long", "").replace(" string", "").split(", ")]
    schema = T.StructType(
        [docs.schema["doc_id"], *T._parse_datatype_string(RESULT + ", kept binary" * keep_text)]
    )
    rows = docs.select(
        "doc_id",
        F.col("text").cast("string"),
        F.xxhash64("doc_id", "text").alias("rid"),
    )
    joined = rows.join(spans, "rid", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_removed(length, [*names, "kept"][: len(schema)], keep_text), schema)
