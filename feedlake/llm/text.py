"""Whole texts as byte arrays: words, their hashes, n-grams, and runs of rows in blocks.

All functions work on the texts of one Arrow column at a time. A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from feedlake.workspace import settle

# Bytes of text that are worked on at a time; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20

# Bytes of rows that Spark hands to a worker at a time; it would take 64 MB.
SLICE_BYTES = 8 << 20
_SLICES = "spark.sql.execution.arrow.maxBytesPerBatch"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)


def word_bytes(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 byte values are in a word, given the ranges that are not."""
    inside = np.ones(256, dtype=bool)
    for low, high in ranges:
        inside[low : high + 1] = False
    return inside


# `[^\x20\x09-\x0D]+` and, for lower-cased text, `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`
SPACED = word_bytes((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = word_bytes((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit values with their bits spread."""
    values = values ^ (values >> _SHIFT)
    values = values * _MIX
    values = values ^ (values >> _SHIFT)
    values = values * _MIX
    return values ^ (values >> _SHIFT)


def blocks(
    batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of the batches of about `max_bytes`, with the column's bytes and row bounds."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends, first = np.cumsum(sizes.to_numpy(), dtype=np.int64), 0
        while first < len(ends):
            done = ends[first - 1] if first else 0
            last = max(int(np.searchsorted(ends, done + max_bytes, "right")), first + 1)
            rows = batch.slice(first, last - first)
            # nulls are filled a piece at a time: filling them copies the texts
            texts = pc.fill_null(rows.column(column), "").cast(pa.large_string())
            bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
            body = texts.buffers()[2]
            body = np.empty(0, np.uint8) if body is None else np.frombuffer(body, np.uint8)
            yield rows, body[bounds[0] : bounds[-1]], bounds - bounds[0]
            first = last


def settle_slices(df: DataFrame, label: str) -> DataFrame:
    """`settle` for a plan that hands texts or sets to Python, in slices of `SLICE_BYTES`.

    A slice is held by the executor, and by the worker together with the one before, so its size
    is most of what a task holds. The session's own setting is back when the rows are written.
    """
    conf = df.sparkSession.conf
    before = conf.getAll.get(_SLICES)
    conf.set(_SLICES, SLICE_BYTES)
    try:
        return settle(df, label)
    finally:
        if before is None:
            conf.unset(_SLICES)
        else:
            conf.set(_SLICES, before)


def with_columns(
    docs: DataFrame,
    own: list[StructField],
    compute: Callable[[np.ndarray, np.ndarray], list[pa.Array]],
) -> DataFrame:
    """`docs` with columns made by `compute` from the bytes and bounds of each block of texts.

    All other columns stay; one that is called like a new one, in whatever case, is replaced. Rows
    travel as one struct, so that their names may hold any character.
    """
    taken = {f.name.lower() for f in own}
    carried = [f"`{c}`" for c in docs.columns if c.lower() not in taken]
    packed = docs.select(F.struct(*carried).alias("row"))
    names = ["row", *(f.name for f in own)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = (pa.RecordBatch.from_struct_array(batch.column("row")) for batch in batches)
        for rows, data, bounds in blocks(opened, "text"):
            arrays = [rows.to_struct_array(), *compute(data, bounds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = StructType([*packed.schema.fields, *own])
    return packed.mapInArrow(run, schema).select("row.*", *names[1:])


class Words:
    """The words of a block: where each starts and ends, its hash, and each row's first word."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, inside: np.ndarray):
        self.data, self.bounds = data, bounds
        within = inside[data]
        begins, finishes = within.copy(), within.copy()
        begins[1:] &= ~within[:-1]
        finishes[:-1] &= ~within[1:]
        edges = bounds[(bounds > 0) & (bounds < len(data))]
        begins[edges] = within[edges]
        finishes[edges - 1] = within[edges - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(finishes) + 1
        self.first = np.searchsorted(self.starts, bounds)  # of each row, and one past the last

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def grams(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of `size` words of one row."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        rows = self.rows
        at = np.flatnonzero(rows[:n] == rows[size - 1 :])
        return at, rolled(hashes, size)[at]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, taken eight bytes at a time."""
    lengths = ends - starts
    result = lengths.astype(np.uint64) * _ODD
    if not len(starts):
        return result
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    live, at, left = np.arange(len(starts)), starts, lengths
    while len(live):
        chunk = eight[at]
        short = left < 8
        keep = (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
        chunk[short] &= keep
        result[live] = mixed(result[live] ^ chunk)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return result


def rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` hashes, in order of the first."""
    n = len(hashes) - size + 1
    total = np.zeros(max(n, 0), np.uint64)
    for k in range(size):
        total = total * _ODD + hashes[k : k + n]
    return mixed(total)


def window_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """Position of the rightmost smallest value of every window of `size` values."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, where, span = values.copy(), np.arange(len(values)), 1
    while span < size:
        step = min(span, size - span)
        left, right = best[:-step], best[step:]
        take = right <= left
        where = np.where(take, where[step:], where[:-step])
        best = np.where(take, right, left)
        span += step
    return where[:n]


def row_numbers(start: int, count: int) -> np.ndarray:
    """Numbers of a task's rows that no other task gives; stable once written."""
    return (np.int64(TaskContext.get().partitionId()) << 36) + np.arange(start, start + count)
