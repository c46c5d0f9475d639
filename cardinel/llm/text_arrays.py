"""Texts of an Arrow column as byte arrays: words, hashes and n-grams without Python strings.

A hash of bytes i..j comes from running sums of a polynomial in an odd base modulo
2^64, mixed at the end. Two different strings share a hash with a chance of about
2^-64, so that one of n strings meets another with a chance of about n / 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes that are worked on at once; a longer text is a piece of its own.
PIECE_BYTES = 2_000_000
PIECE_ROWS = 512

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2)
VALUES = _VALUES + np.uint64(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = {BASE: np.ones(1, np.uint64), BASE_INVERSE: np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    have = _powers[base]
    if len(have) < n:
        steps = np.full(max(n, PIECE_BYTES), base, np.uint64)
        steps[0] = 1
        _powers[base] = have = np.multiply.accumulate(steps)
    return have[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins and the last ends; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    n = len(column)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    if data is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(
    column: pa.Array, size: int = PIECE_BYTES, rows: int = PIECE_ROWS
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, bytes and offsets of runs of texts of a bounded size."""
    data, at = utf8(column)
    row, n = 0, len(at) - 1
    while row < n:
        end = int(np.searchsorted(at, at[row] + size, "right")) - 1
        end = min(max(end, row + 1), row + rows, n)
        yield row, end, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def running(data: np.ndarray) -> np.ndarray:
    """Running sums from which `span_hash` takes the hash of any span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(VALUES[data] * powers(BASE, len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    back = powers(BASE_INVERSE, len(sums))
    return mix((sums[end] - sums[start]) * back[start])


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word; words end at white space and text ends."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~IS_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | cut[1:n]
    last[:-1] &= ~word[1:] | cut[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(at, start, "right") - 1


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word, ASCII capitals as small letters."""
    data = LOWER[data]
    start, end, text = word_spans(data, at)
    return span_hash(running(data), start, end), text


def sums_by(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(group, values, n) if len(group) else np.zeros(n)
