"""Toxicity by FTRL-proximal logistic regression over hashed word features (9).

A text's features are its distinct words, word pairs and pairs with one word left out between them,
hashed into `2^BITS` places. Words are lower-cased (A-Z) runs of letters and digits. Training keeps
a learning rate per coordinate, and its L1 term leaves a weight of exactly zero to all features that
labels say little about, so the model is a short list of places and weights.

The model is fitted on a sample of labelled rows, drawn by a hash of the id: the first `MOST_ROWS` in
the order of that hash, or fewer, as many as hold `MOST_PLACES` features together. Both are
documented bounds, of rows and of memory. Of an id that repeats, one row is in the sample. Scoring
reads every text whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from feedlake.llm.text import ALPHANUMERIC, LOWER, Words, blocks, mixed, with_columns
from feedlake.workspace import settle

BITS = 22
MOST_ROWS = 16_000
MOST_PLACES = 64 << 20  # four bytes each in the task that trains

ALPHA, BETA, L1, L2 = 0.5, 1.0, 15.0, 0.1
EPOCHS = 6

_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
_SKIP = np.uint64(0x165667B19E3779F9)


@dataclass(frozen=True)
class Model:
    """The weights that are not zero; their number is at most `2^BITS`. No places: knows nothing."""

    places: np.ndarray
    weights: np.ndarray
    bias: float


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of every feature of a block, in no order and with repeats."""
    words = Words(LOWER[data], bounds, ALPHANUMERIC)
    hashes, rows = words.hashes(), words.rows
    mask = np.uint64((1 << BITS) - 1)
    parts = [(rows, mixed(hashes))]
    for gap, factor in ((1, _PAIR), (2, _SKIP)):
        inside = rows[:-gap] == rows[gap:]
        pair = mixed(hashes[:-gap] * factor + hashes[gap:])
        parts.append((rows[:-gap][inside], pair[inside]))
    places = np.concatenate([p for _, p in parts]) & mask
    return np.concatenate([r for r, _ in parts]), places.astype(np.int64)


def _smallest(known: DataFrame, most: int) -> DataFrame:
    """Rows of `known` that hold its `most` smallest values of `order`, and few others.

    Hashes are spread evenly, so a bound that twice as many should lie below is enough; if it is not,
    it is raised. Thus no task has many rows to sort, however many labels there are.
    """
    total, wanted = known.count(), 2 * most
    while wanted < total:
        below = known.where(F.col("order") < int(-(2**63) + 2**64 * (wanted / total)))
        if below.count() >= most:
            return below
        wanted *= 2
    return known


def _training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """`toxic, order, places` of the sampled labelled rows, one for each id that is drawn."""
    known = labels.where("doc_id is not null and toxic is not null")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.col("doc_id").cast("string")).alias("order")
    known = settle(known.select("doc_id", "toxic", order), "labelled")
    drawn = settle(_smallest(known, most).orderBy("order", "doc_id").limit(most), "drawn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in blocks(batches, "text"):
            row, place = features(data, bounds)
            keys = np.unique((row << BITS) | place)
            ends = np.searchsorted(keys >> BITS, np.arange(len(rows)), "right")
            places = pa.array((keys & ((1 << BITS) - 1)).astype(np.int32))
            lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), places)
            yield pa.RecordBatch.from_arrays(
                [rows.column("toxic").cast(pa.int32()), rows.column("order"), lists],
                names=["toxic", "order", "places"],
            )

    # at most `most` ids, written, so that Spark knows their size
    chosen = docs.select("doc_id", "text").join(drawn, "doc_id")
    # of several rows of an id one counts, whichever task they are in: the one of the smallest hash
    hashed = F.struct(F.xxhash64("text").alias("hash"), "text")
    chosen = chosen.groupBy("doc_id", "toxic", "order").agg(F.min(hashed).alias("least"))
    chosen = chosen.select("toxic", "order", F.col("least.text").alias("text"))
    return chosen.mapInArrow(run, "toxic int, order bigint, places array<int>")


def _fit(examples: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over the examples, in order, `EPOCHS` times. The bias has no L1 term."""
    bias = 1 << BITS
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)

    def weight(at: np.ndarray) -> np.ndarray:
        l1 = np.where(at == bias, 0.0, L1)
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for toxic, places in examples:
            at = np.append(places, bias)
            w = weight(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - toxic
            grown = n[at] + gradient * gradient
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    held = np.flatnonzero(np.abs(z[:bias]) > L1)
    return held, weight(held), float(weight(np.array([bias]))[0])


def _examples(batches: Iterator[pa.RecordBatch], most: int) -> list[tuple[int, np.ndarray]]:
    """Label and places of the first rows, as many as hold `most` places; at least one row.

    The places are slices of the batches that came, not copies.
    """
    found, held = [], 0
    for batch in batches:
        lists = batch.column("places")
        places, ends = lists.flatten().to_numpy(), np.cumsum(pc.list_value_length(lists))
        first = 0
        for toxic, end in zip(batch.column("toxic").to_numpy(), ends, strict=True):
            held += int(end) - first
            if found and held > most:
                return found
            found.append((int(toxic), places[first:end]))
            first = int(end)
    return found


def fit(
    docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS, most_places: int = MOST_PLACES
) -> Model:
    """A model of `labels(doc_id, toxic)` for the texts of `docs`.

    A document with several labels counts as toxic if one says so; labels without id or value are
    left out. Without any labelled text the model knows nothing and scores 0. Rows are taken in the
    order of their id's hash until there are `most`, or until the next would make over `most_places`
    features.
    """

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = _examples(batches, most_places)
        if not examples:
            return
        places, weights, bias = _fit(examples)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(places, -1)), pa.array(np.append(weights, bias))],
            names=["place", "weight"],
        )

    # one task by design: the sample is bounded, and each step depends on the last
    examples = _training_rows(docs, labels, most).repartition(1)
    ordered = examples.sortWithinPartitions("order", "toxic", F.size("places"))
    found = dict(ordered.mapInArrow(train, "place bigint, weight double").collect())
    bias = found.pop(-1, None)
    if bias is None:
        return Model(np.empty(0, np.int64), np.empty(0), -np.inf)
    return Model(np.array([*found], np.int64), np.array([*found.values()]), bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with `score`, the model's probability that a text is toxic.

    A null or empty text has no features and gets the bias alone. All other columns stay; a column
    called score is replaced. Only the text is looked at.
    """

    def compute(data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
        table = np.zeros(1 << BITS, np.float32)
        table[model.places] = model.weights
        row, place = features(data, bounds)
        known = table[place] != 0
        keys = np.unique((row[known] << BITS) | place[known])
        weights = table[keys & ((1 << BITS) - 1)].astype(float)
        total = np.bincount(keys >> BITS, weights, len(bounds) - 1) + model.bias
        with np.errstate(over="ignore"):
            return [pa.array(1 / (1 + np.exp(-total)))]

    return with_columns(docs, [StructField("score", DoubleType())], compute)
