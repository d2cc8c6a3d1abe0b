"""Whole texts of Arrow batches as flat numpy arrays: words, word windows and their 64-bit hashes.

Nothing here depends on how rows are batched: a text is always hashed whole, and memory follows ``BLOCK`` bytes plus the
longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

BLOCK = 4 << 20
HASH_BLOCK = 1 << 20
BATCH_BYTES = 8 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES`` or so, however long single texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns; a clear error if one is missing. Other columns may have any name."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"columns {missing} are missing; there are {df.columns}")
    return df.select(*[f"`{c}`" for c in columns])


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each, or a single longer row; no empty ones."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(sizes + 16) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and each text's start; one more start closes the last. A null text is empty."""
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = column.cast(pa.large_binary())
    _, starts, data = wide.buffers()
    starts = np.frombuffer(starts, np.int64, len(wide) + 1, wide.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(wide) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every run of non-space bytes, and the number of words before each text."""
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = inside[edges]
    edges = edges[edges > 0]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hashes of byte spans that are in order and don't overlap; with ``fold``, A-Z count as a-z."""
    out = np.empty(len(starts), np.uint64)
    table = BYTE[LOWER] if fold else BYTE
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + HASH_BLOCK, "right")))
        a, b = int(starts[at]), int(ends[to - 1])
        power = np.empty(b - a, np.uint64)
        power[0], power[1:] = 1, BASE
        np.multiply.accumulate(power, out=power)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(table[data[a:b]] * power, out=total[1:])
        low, high = starts[at:to] - a, ends[at:to] - a
        undo = _inverse_powers(b - a)
        out[at:to] = mix((total[high] - total[low]) * undo[low] + (high - low).astype(np.uint64))
        at = to
    return out


_UNDO = np.ones(1, np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    global _UNDO
    if len(_UNDO) < n:
        _UNDO = np.full(max(n, HASH_BLOCK), UNBASE, np.uint64)
        _UNDO[0] = 1
        np.multiply.accumulate(_UNDO, out=_UNDO)
    return _UNDO


def window_hashes(words: np.ndarray, before: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words inside one text: hash, index of the first word, windows before each text."""
    n = max(0, len(words) - size + 1)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total = total * BASE + words[j : j + n]
    whole = np.ones(n, bool)
    for j in range(1, size):  # a window must not hold the first word of a later text but at its own start
        edge = before[1:-1] - j
        whole[edge[(edge >= 0) & (edge < n)]] = False
    first = np.flatnonzero(whole)
    return mix(total[first] + np.uint64(size)), first, np.searchsorted(first, before)


def shingle_sets(words: np.ndarray, before: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct word windows as sorted hashes, and the start of each set.

    A text with fewer words than ``size`` has its whole sequence as one shingle; one without words has none.
    """
    hashes, _, start = window_hashes(words, before, size)
    out, ends = [], [0]
    for i in range(len(before) - 1):
        a, b = before[i], before[i + 1]
        if b - a >= size:
            own = np.unique(hashes[start[i] : start[i + 1]])
        elif b > a:
            own = window_hashes(words[a:b], np.array([0, b - a]), int(b - a))[0]
        else:
            own = hashes[:0]
        out.append(own)
        ends.append(ends[-1] + len(own))
    return (np.concatenate(out) if out else hashes[:0]), np.array(ends)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
