"""Audit of how filters act together, by contractions of a contingency tensor (11).

Every document has one bit per filter: does it fail it? Per part of the corpus the documents are
counted by their bits, which gives a tensor with one axis of two per filter. All that is asked of an
order of filters is a contraction of that tensor: each axis takes those that pass, those that fail,
or all. So the texts are read once, whatever the number of orders, and what leaves the tasks is at
most 32 counts for each part.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField

from feedlake.llm.bitmap import text_hash
from feedlake.llm.text import SPACED, Words, with_columns
from feedlake.workspace import settle

FILTERS = "ABCDE"
COUNTS = ("documents", "good", "toxic")

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)

_CAPITAL = np.zeros(256, np.int64)
_CAPITAL[ord("A") : ord("Z") + 1] = 1
_CONTINUES = np.zeros(256, np.int64)
_CONTINUES[0x80:0xC0] = 1
_SIGN = np.zeros(256, np.int64)
_SIGN[list(b"#$%&*|")] = 1


def _per_row(kind: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many bytes of each row are of a kind."""
    total = np.concatenate([[0], np.cumsum(kind[data])])
    return total[bounds[1:]] - total[bounds[:-1]]


def text_failures(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Bits of the filters on a text alone, for each row: A is 1, B is 2, C is 4, D is 8."""
    words = Words(data, bounds, SPACED)
    counts = words.counts
    hashes, rows = words.hashes(), words.rows
    order = np.lexsort((hashes, rows))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    distinct = np.bincount(rows[order][fresh], minlength=len(counts))
    points = np.diff(bounds) - _per_row(_CONTINUES, data, bounds)
    failures = (
        counts < 200,
        100 * distinct < 50 * counts,
        100 * _per_row(_CAPITAL, data, bounds) > 3 * points,
        _per_row(_SIGN, data, bounds) > 0,
    )
    return sum(fails.astype(np.int32) << k for k, fails in enumerate(failures))


def filter_failures(docs: DataFrame, part: str) -> DataFrame:
    """`part, doc_id, failures` of every row of `docs`; bit k is set where filter k fails it.

    A: under 200 words. B: under half of the words are distinct. C: over 3 % capital letters. D: one
    of `#$%&*|`. E: the text of a row with a smaller `doc_id`. A null text is an empty one and a null
    part is called ''. A row without id follows all others; of rows that share an id none comes
    first. Other columns are not looked at.
    """
    rows = docs.select(
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("text_hash", text_hash())

    def bits(data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
        return [pa.array(text_failures(data, bounds))]

    judged = with_columns(rows, [StructField("failures", IntegerType())], bits)
    judged = settle(judged.drop("text"), "judged")
    # copies meet before the shuffle; joined by the id as well, the rows of a common text are dealt
    # out evenly
    first = judged.groupBy("text_hash").agg(F.min("doc_id").alias("first_id"))
    first = settle(first, "first").withColumnRenamed("text_hash", "first_hash")
    leads = (F.col("text_hash") == F.col("first_hash")) & F.col("doc_id").eqNullSafe(
        F.col("first_id")
    )
    copy = F.when(F.col("first_hash").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    return judged.join(first, leads, "left").select(
        "part", "doc_id", F.col("failures").bitwiseOR(copy).alias("failures")
    )


def contingency(failures: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, the documents of each combination of failures, and the good and toxic ones of them.

    Columns: `part, cells`, an array of at most 2^5 structs. A document is good or toxic if any row
    of `labels(doc_id, quality, toxic)` says so; one without label is neither.
    """
    marks = labels.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"),
        F.max((F.col("toxic") == 1).cast("long")).alias("toxic"),
    )
    marked = failures.join(marks, F.col("doc_id") == F.col("label_id"), "left")
    counted = marked.groupBy("part", "failures").agg(
        F.count("*").alias("documents"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )
    return counted.groupBy("part").agg(
        F.collect_list(F.struct("failures", *COUNTS)).alias("cells")
    )


def orders() -> list[tuple[int, ...]]:
    """All orders of the filters, each as the filters' numbers."""
    return list(itertools.permutations(range(len(FILTERS))))


def _selectors(choose) -> np.ndarray:
    """For every order and step, and for each filter's axis, what `choose(place, step)` takes."""
    chosen = [
        [choose(order.index(f), step) for f in range(len(FILTERS))]
        for order in orders()
        for step in range(len(FILTERS))
    ]
    return np.array(chosen, np.int64)


def contracted(tensors: np.ndarray, selectors: np.ndarray) -> np.ndarray:
    """Sums of each tensor (the first axis) by each selector: one row of sums per tensor."""
    axes = [selectors[:, f] for f in range(len(FILTERS))]
    return np.einsum("pabcde,xa,xb,xc,xd,xe->px", tensors, *axes, optimize="greedy")


def audited(documents: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """The report of each part's tensors; every array has a row per part and all steps in it."""
    kept = _selectors(lambda place, step: PASS if place <= step else ALL)
    removed = _selectors(
        lambda place, step: PASS if place < step else FAIL if place == step else ALL
    )
    failing = _selectors(lambda place, step: FAIL if place == step else ALL)
    alone = _selectors(lambda place, step: FAIL if place == step else PASS)
    gone = contracted(documents, removed)
    filters = np.array(orders()).ravel()
    total = np.stack([gone[:, filters == f].sum(axis=1) for f in range(len(FILTERS))], axis=1)
    return {
        "kept": contracted(documents, kept),
        "removed": gone,
        "redundant": contracted(documents, failing) - gone,
        "unique_fails": contracted(documents, alone),
        "good_lost": contracted(good, removed),
        "toxic_lost": contracted(toxic, removed),
        "shapley": total[:, filters],
    }


# Parts whose reports are made at a time.
PARTS = 64

_REPORT = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(cells: DataFrame) -> DataFrame:
    """A row per part of `cells(part, cells)`, order of the filters and step of it, zeros included.

    Columns: `part, filter_order, step`, and per step the documents that are kept after it; removed
    by it; that fail its filter but were removed before; that fail no other filter; the good and the
    toxic ones that it removes; and its filter's removals summed over all orders.
    """
    names = ["".join(FILTERS[f] for f in order) for order in orders()]
    steps = len(FILTERS)

    def tensors(batch: pa.RecordBatch) -> list[np.ndarray]:
        lists = batch.column("cells")
        rows = np.repeat(np.arange(len(batch)), lists.value_lengths())
        bits = lists.flatten().field("failures").to_numpy()
        axes = [(bits >> f) & 1 for f in range(steps)]
        made = []
        for name in COUNTS:
            tensor = np.zeros((len(batch), *[2] * steps), np.int64)
            tensor[(rows, *axes)] = lists.flatten().field(name).to_numpy()
            made.append(tensor)
        return made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), PARTS):
                batch = whole.slice(begin, PARTS)
                size = len(names) * steps
                report = audited(*tensors(batch))
                at = pa.array(np.repeat(np.arange(len(batch)), size))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("part").take(at),
                        pa.array(np.tile(np.repeat(names, steps), len(batch))),
                        pa.array(np.tile(np.arange(1, steps + 1), len(names) * len(batch)), pa.int32()),
                        *(pa.array(report[c].ravel()) for c in _REPORT),
                    ],
                    names=["part", "filter_order", "step", *_REPORT],
                )

    longs = ", ".join(f"{c} bigint" for c in _REPORT)
    return cells.mapInArrow(run, f"part string, filter_order string, step int, {longs}")


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """What each step of every order of the five filters does to each part of `docs`.

    See `filter_failures` for the filters and for null, empty and repeated rows, `contingency` for
    labels and `audit` for the columns. Without documents there is no part and no row.
    """
    return audit(contingency(filter_failures(docs, part), labels))
