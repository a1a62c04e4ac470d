"""Benchmark decontamination by winnowing (2).

Texts are lower-cased (A-Z) and cut into words. A window is `WINDOW` consecutive words of an item,
or all words of a shorter item. Of the `GRAM`-word hashes in a window the rightmost smallest is its
fingerprint; as that depends on nothing but the window's words, any shared window has the same one
in a document and in an item, so no shared span of `WINDOW` words is missed.

Document windows whose fingerprint is one of the items' (a bitmap of fixed size tells, and lets some
others through) are joined with the items' windows on a 128-bit hash, which settles the hit and its
extent. Windows are joined as distinct ones, so a passage that many items and many documents hold
does not multiply: a hit carries the name of a list of items, and each document's lists are attached
to it once, afterwards. Pairs that share a fingerprint alone are not made, as a frequent one would
make them for all its documents and items; the hash of the whole window stands for the extension.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.bitmap import bitmap, may_hold, text_hash
from feedlake.llm.text import (
    ALPHANUMERIC,
    LOWER,
    Words,
    blocks,
    mixed,
    rolled,
    row_numbers,
    settle_slices,
)
from feedlake.workspace import settle

WINDOW = 10
GRAM = 5

_OTHER = np.uint64(0xA24BAED4963EE407)

_WINDOW = "size int, high bigint, low bigint"
_KEY = ["size", "high", "low"]


class _Grams:
    """Word windows of a block's rows."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.words = Words(LOWER[data], bounds, ALPHANUMERIC)
        self.hashes = self.words.hashes()
        self.rows = self.words.rows

    def starts(self, size: int) -> np.ndarray:
        """First words of the windows of `size` words."""
        n = max(len(self.hashes) - size + 1, 0)
        return np.flatnonzero(self.rows[:n] == self.rows[size - 1 :][:n])

    def keys(self, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that stand for the windows of `size` words from `at`."""
        if not len(at):
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        spread = self.hashes[at[:, None] + np.arange(size)]
        high, low = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
        for k in range(size):
            high = mixed(high ^ spread[:, k])
            low = mixed(low * _OTHER + spread[:, k])
        return high, low

    def fingerprints(self, at: np.ndarray, size: int) -> np.ndarray:
        """The fingerprint of each window; of a window below `WINDOW` words, its own hash."""
        if size < WINDOW:
            return rolled(self.hashes, size)[at] + np.uint64(size)
        grams = rolled(self.hashes, GRAM)
        return smallest(grams, WINDOW - GRAM + 1)[at]


def smallest(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest value of every window of `size` values."""
    span = 1
    while span < size:
        step = min(span, size - span)
        values = np.minimum(values[:-step], values[step:])
        span += step
    return values


def _item_windows(benchmark: DataFrame) -> DataFrame:
    """Every window of every item, with its fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in blocks(batches, "text"):
            grams = _Grams(data, bounds)
            counts, first = grams.words.counts, grams.words.first
            for size in range(1, WINDOW + 1):
                at = grams.starts(WINDOW) if size == WINDOW else first[:-1][counts == size]
                if not len(at):
                    continue
                high, low = grams.keys(at, size)
                print_ = grams.fingerprints(at, size)
                item = rows.column("item").take(pa.array(grams.rows[at]))
                yield pa.RecordBatch.from_arrays(
                    [
                        item,
                        pa.array(np.full(len(at), size, np.int32)),
                        *(pa.array(x.view(np.int64)) for x in (high, low, print_)),
                    ],
                    names=["item", "size", "high", "low", "print"],
                )

    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text"
    )
    return items.mapInArrow(run, f"item string, {_WINDOW}, print bigint").distinct()


def _candidates(docs: DataFrame, prints: np.ndarray, sizes: list[int]) -> DataFrame:
    """Per document: its words, and its windows that may be an item's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for rows, data, bounds in blocks(batches, "text"):
            grams = _Grams(data, bounds)
            found = []
            for size in sizes:
                at = grams.starts(size)
                if len(at):
                    at = at[may_hold(prints, grams.fingerprints(at, size))]
                found.append((at, np.full(len(at), size), *grams.keys(at, size)))
            at, size, high, low = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(at, kind="stable")
            at, size, high, low = at[order], size[order], high[order], low[order]
            row = grams.rows[at]
            ends = np.searchsorted(row, np.arange(len(bounds) - 1), "right")
            windows = pa.StructArray.from_arrays(
                [
                    pa.array(at - grams.words.first[row]),
                    pa.array(size.astype(np.int32)),
                    pa.array(high.view(np.int64)),
                    pa.array(low.view(np.int64)),
                ],
                names=["start", "size", "high", "low"],
            )
            lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), windows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row_numbers(done, len(rows))),
                    rows.column("doc_id"),
                    rows.column("text_hash"),
                    pa.array(grams.words.counts),
                    lists,
                ],
                names=["row", "doc_id", "text_hash", "n_words", "windows"],
            )
            done += len(rows)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_hash().alias("text_hash"), "text").mapInArrow(
        run,
        f"row bigint, doc_id {kind}, text_hash string, n_words bigint, "
        "windows array<struct<start: bigint, size: int, high: bigint, low: bigint>>",
    )


def _covered(spans) -> F.Column:
    """Words in the union of `(start, end)` spans, which are sorted."""
    zero = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        spans,
        zero,
        lambda done, span: F.struct(
            (
                done["words"]
                + F.greatest(F.lit(0), span["end"] - F.greatest(span["start"], done["end"]))
            ).alias("words"),
            F.greatest(span["end"], done["end"]).alias("end"),
        ),
        lambda done: done["words"],
    )


def benchmark_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: `doc_id, text_hash, n_words, n_hit, spans, items`.

    `spans` are the `(start, end)` word spans of its windows that an item holds too, sorted, and
    `n_hit` the words in them; `items` are the ids, as text and sorted, of the items with such a
    window. Both are empty for a document without hits. A null or empty text has no words. Repeated
    rows are each returned. An item without id counts as the item "". Without items nothing is hit.
    """
    items = settle_slices(_item_windows(benchmark), "items")
    sizes = [row.size for row in items.select("size").distinct().collect()]  # WINDOW rows at most
    prints = bitmap(items, "print")
    marked = settle_slices(_candidates(docs, prints, sizes or [WINDOW]), "windows")

    # windows with the same items share a list of them, which hits name by its hash
    held = items.groupBy(*_KEY).agg(F.sort_array(F.collect_set("item")).alias("items"))
    held = settle(held.withColumn("listed", F.md5(F.to_json("items").cast("binary"))), "held")
    hits = settle(
        marked.where(F.size("windows") > 0)
        .select("row", F.inline("windows"))
        .join(held.select(*_KEY, "listed"), _KEY)
        .select("row", "start", (F.col("start") + F.col("size")).alias("end"), "listed"),
        "hits",
    )
    covered = hits.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans")
    )
    lists = held.groupBy("listed").agg(F.first("items").alias("items"))
    named = (
        hits.select("row", "listed")
        .distinct()
        .join(lists, "listed")
        .groupBy("row")
        .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    )
    per_row = covered.join(named, "row")
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    spans = F.coalesce("spans", none)
    return marked.join(per_row, "row", "left").select(
        "doc_id",
        "text_hash",
        "n_words",
        _covered(spans).alias("n_hit"),
        spans.alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, whose text holds no window of an item.

    Null and empty texts hold none and stay; repeated rows stay or go together.
    """
    hits = benchmark_hits(docs, benchmark).where(F.col("n_hit") > 0)
    hit = settle(hits.select("text_hash").distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("row")).withColumn("text_hash", text_hash("row.text"))
    held = hit.withColumnRenamed("text_hash", "hit")
    return rows.join(held, F.col("text_hash") == F.col("hit"), "left_anti").select("row.*")
