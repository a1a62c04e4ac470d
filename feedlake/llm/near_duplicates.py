"""Near duplicates by one-permutation MinHash (10).

A text's set is its distinct 5-word shingles, as 64-bit hashes. One pass hashes every shingle once
into one of `BINS` bins and keeps each bin's minimum; an empty bin borrows from a bin that a
universal hash of (bin, attempt) names, trying on until that one is not empty (optimal
densification). `BANDS` bands of `ROWS` bins give the buckets.

Equal sets are first merged to one class, so copies cost nothing further. In each bucket only a star
is proposed: every class with the one that meets most others. Proposed links are confirmed on full
sets, and components found. A star can miss a link between two of its spokes. So the classes of
buckets that still hold more than one component are joined once more, by their rare shingles, which
misses no link between them and makes few pairs besides. Thus no pair that shares a bucket is left
out, yet a bucket of near copies costs one link per member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.bitmap import bitmap, may_hold, text_hash
from feedlake.llm.components import components
from feedlake.llm.text import LOWER, SPACED, Words, blocks, mixed, rolled, settle_slices
from feedlake.workspace import settle

SHINGLE = 5
BANDS, ROWS = 25, 5
BINS = BANDS * ROWS

# Pairs whose share of equal minima is this many standard deviations below the similarity asked for
# are not compared on full sets. A set smaller than the bins has only so many independent ones.
DEVIATIONS = 5

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every row, sorted, and each row's first place among them."""
    words = Words(LOWER[data], bounds, SPACED)
    hashes, counts = words.hashes(), words.counts
    sizes = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(sizes)])
    grams = np.empty(first[-1], np.uint64)
    grams[np.repeat(counts >= SHINGLE, sizes)] = words.grams(hashes, SHINGLE)[1]
    for size in range(1, SHINGLE):
        row = np.flatnonzero(counts == size)
        if len(row):
            grams[first[row]] = rolled(hashes, size)[words.first[row]] + np.uint64(size)
    for start, end in zip(first[:-1], first[1:], strict=True):
        grams[start:end].sort()
    fresh = np.ones(len(grams), bool)
    fresh[1:] = grams[1:] != grams[:-1]
    fresh[first[:-1][sizes > 0]] = True
    return grams[fresh], np.concatenate([[0], np.cumsum(fresh)])[first]


def minima(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of `BINS` densified minima for each set that is not empty.

    A shingle's bin is given by its upper bits, so that in a sorted set each bin's first shingle is
    its minimum.
    """
    counts = np.diff(first)
    place = np.repeat(np.cumsum(counts > 0) - 1, counts)
    bins = ((grams >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    slot = place * BINS + bins.astype(np.int64)
    least = np.ones(len(slot), bool)
    least[1:] = slot[1:] != slot[:-1]
    found = np.full(np.count_nonzero(counts) * BINS, _NONE, np.uint64)
    found[slot[least]] = mixed(grams[least])
    found = found.reshape(-1, BINS)
    result, attempt = found.copy(), 0
    empty_row, empty_bin = np.nonzero(found == _NONE)
    while len(empty_row):
        tried = (empty_bin.astype(np.uint64) << np.uint64(32)) + np.uint64(attempt)
        donor = mixed(mixed(tried) + np.uint64(1)) % np.uint64(BINS)
        value = found[empty_row, donor.astype(np.int64)]
        good = value != _NONE
        result[empty_row[good], empty_bin[good]] = value[good]
        empty_row, empty_bin, attempt = empty_row[~good], empty_bin[~good], attempt + 1
    return result


def _sketches(docs: DataFrame) -> DataFrame:
    """Per row: its set's size and 128-bit name, and the low half of every minimum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in blocks(batches, "text"):
            grams, first = shingle_sets(data, bounds)
            counts = np.diff(first)
            full = counts > 0
            names = np.zeros((len(rows), 2), np.uint64)
            for k in (0, 1):
                sums = np.zeros(len(grams) + 1, np.uint64)
                np.cumsum(mixed(grams + np.uint64(k)), out=sums[1:])
                names[:, k] = mixed(sums[first[1:]] - sums[first[:-1]] + counts.astype(np.uint64))
            signs = minima(grams, first).astype(np.uint32)
            at = np.cumsum(full) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("text_hash"),
                    pa.array(counts),
                    pa.array(
                        [n.tobytes() if f else None for n, f in zip(names, full, strict=True)],
                        pa.binary(),
                    ),
                    pa.array(
                        [signs[a].tobytes() if f else None for a, f in zip(at, full, strict=True)],
                        pa.binary(),
                    ),
                ],
                names=["doc_id", "text_hash", "n_shingles", "class", "signs"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_hash().alias("text_hash"), "text").mapInArrow(
        run,
        f"doc_id {kind}, text_hash string, n_shingles bigint, class binary, signs binary",
    )


def _bands(classes: DataFrame) -> DataFrame:
    """`bucket, class`: the buckets of every class."""
    width = 4 * ROWS
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda band: F.xxhash64(band, F.substring(F.col("signs"), band * width + 1, F.lit(width))),
    )
    return classes.select(F.explode(keys).alias("bucket"), "class")


def _agreeing(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes and minima leave a link possible."""
    share = percent / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, BINS)
                for c in ("a_signs", "b_signs")
            )
            independent = np.minimum(batch.column("smaller").to_numpy(), BINS)
            slack = DEVIATIONS * np.sqrt(share * (1 - share) / independent)
            alike = (left == right).mean(axis=1) >= share - slack
            yield batch.select(["a", "b"]).filter(pa.array(alike))

    smaller, larger = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    possible = pairs.where(100 * smaller >= percent * larger)
    return possible.select("a", "b", "a_signs", "b_signs", smaller.alias("smaller")).mapInArrow(
        run, "a binary, b binary"
    )


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """`class, shingles` of the classes in `wanted(class, text_hash)`."""
    wanted = settle(wanted, "wanted")
    known = bitmap(wanted.select(F.xxhash64("text_hash").alias("h")), "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def asked():
            for batch in batches:
                hashes = batch.column("h").to_numpy().view(np.uint64)
                yield batch.filter(pa.array(may_hold(known, hashes)))

        for rows, data, bounds in blocks(asked(), "text"):
            grams, first = shingle_sets(data, bounds)
            sets = [grams[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("text_hash"), pa.array(sets, pa.binary())],
                names=["text_hash", "shingles"],
            )

    hashed = docs.select(text_hash().alias("text_hash"), "text")
    sets = hashed.select("text_hash", F.xxhash64("text_hash").alias("h"), "text").mapInArrow(
        run, "text_hash string, shingles binary"
    )
    # copies of a text meet before the shuffle where they can, and give one row after it
    sets = sets.groupBy("text_hash").agg(F.first("shingles").alias("shingles"))
    return sets.join(wanted, "text_hash").select("class", "shingles")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have `100 * intersection >= percent * union`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(len(batch), bool)
            left, right = batch.column("a_set"), batch.column("b_set")
            for i in range(len(batch)):
                a = np.frombuffer(left[i].as_buffer(), np.uint64)
                b = np.frombuffer(right[i].as_buffer(), np.uint64)
                both = np.sort(np.concatenate([a, b]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                linked[i] = 100 * shared >= percent * (len(both) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(linked))

    a = sets.select(F.col("class").alias("a"), F.col("shingles").alias("a_set"))
    b = sets.select(F.col("class").alias("b"), F.col("shingles").alias("b_set"))
    return pairs.join(a, "a").join(b, "b").mapInArrow(run, "a binary, b binary")


def _central_stars(shared: DataFrame) -> DataFrame:
    """Pairs of each bucket's hub with its other classes.

    The hub is the class that meets most others over all buckets: of copies that were each changed a
    little, the one nearest to what they were made from.
    """
    sizes = shared.groupBy("bucket").agg(F.count("*").alias("n"))
    met = shared.join(sizes, "bucket").groupBy("class").agg(F.sum("n").alias("met"))
    ranked = shared.join(met, "class")
    hubs = ranked.groupBy("bucket").agg(F.max(F.struct("met", "class"))["class"].alias("hub"))
    return (
        shared.join(hubs, "bucket")
        .where(F.col("hub") != F.col("class"))
        .select(F.least("hub", "class").alias("a"), F.greatest("hub", "class").alias("b"))
        .distinct()
    )


def _unsettled(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """`class, label` of the classes in buckets that hold more than one component."""
    named = shared.join(labels, F.col("class") == F.col("id"), "left").select(
        "bucket", "class", F.coalesce("label", "class").alias("label")
    )
    several = named.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    several = several.where("x <> y").select("bucket")
    return named.join(several, "bucket").groupBy("class").agg(F.first("label").alias("label"))


def _shingles(sets: DataFrame) -> DataFrame:
    """`class, n, shingle`: a row for each shingle of a set of `n`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                shingles = np.frombuffer(batch.column("shingles")[i].as_buffer(), np.int64)
                name = batch.column("class").take(pa.array(np.full(len(shingles), i)))
                yield pa.RecordBatch.from_arrays(
                    [name, pa.array(np.full(len(shingles), len(shingles))), pa.array(shingles)],
                    names=["class", "n", "shingle"],
                )

    return sets.select("class", "shingles").mapInArrow(run, "class binary, n bigint, shingle bigint")


def _rare_partners(sets: DataFrame, unsettled: DataFrame, percent: int) -> DataFrame:
    """Pairs of `unsettled` classes of different components that may be linked, missing none.

    Shingles are ordered by how many of the sets hold them, rare ones first. Linked sets share one
    of the first `n - least overlap + 1` of either, and what follows it bounds the overlap. A set
    with more shingles of its own than a link leaves room for is out before any pair is made. Where
    a shingle's sets are mostly of one component, only the others look for partners.
    """
    spread = settle_slices(_shingles(sets.join(unsettled, "class", "left_semi")), "shingles")
    held = spread.groupBy("shingle").agg(F.count("*").alias("held"))
    ordered = (
        spread.join(held, "shingle")
        .groupBy("class")
        .agg(
            F.first("n").alias("n"),
            F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("order"),
        )
    )
    room = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    prefix = ordered.select(
        "class", "n", F.posexplode(F.slice("order", F.lit(1), room.cast("int")))
    ).select("class", "n", F.col("pos").alias("at"), "col.held", "col.shingle")
    prefix = prefix.where("held > 1").join(unsettled, "class")
    prefix = settle(prefix.select("shingle", "class", "n", "at", "label"), "prefixes")

    sizes = prefix.groupBy("shingle", "label").agg(F.count("*").alias("k"))
    main = sizes.groupBy("shingle").agg(F.max_by("label", "k").alias("main"))
    minor = prefix.join(main, "shingle").where(F.col("label") != F.col("main")).drop("main")
    a = minor.toDF("shingle", "a", "n_a", "at_a", "label_a")
    b = prefix.toDF("shingle", "b", "n_b", "at_b", "label_b")
    overlap = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    possible = (
        (F.col("label_a") != F.col("label_b"))
        & ((100 + percent) * overlap >= percent * (F.col("n_a") + F.col("n_b")))
        & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    )
    return (
        a.join(b, "shingle")
        .where(possible)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Per row of `docs(doc_id, text)`: `doc_id, text_hash, n_shingles, component_id, kept`.

    Texts with Jaccard similarity of at least `percent` hundredths are linked, and a component is
    what links reach; `component_id` is its smallest `doc_id`. With fewer than five words the whole
    sequence is the only shingle. Null, empty and wordless texts have no shingle, are linked with
    nothing and are kept. Repeated rows are each returned, with the same answer. A row without id
    never names a component, unless none of its rows has an id; it is kept only then.
    """
    rows = settle_slices(_sketches(docs), "sketches")
    classes = settle(
        rows.where("class is not null")
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("least"),
            F.min("text_hash").alias("text_hash"),
            F.min("signs").alias("signs"),
            F.min("n_shingles").alias("n"),
        ),
        "classes",
    )
    bands = settle(_bands(classes), "bands")
    crowded = bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = settle(bands.join(crowded, "bucket").select("bucket", "class"), "shared")
    signs = classes.join(shared.select("class").distinct(), "class", "left_semi")
    signs = settle(signs.select("class", "text_hash", "signs", "n"), "signs")
    sets = settle_slices(_sets_of(docs, signs.select("class", "text_hash")), "sets")

    def linked(pairs: DataFrame) -> DataFrame:
        for x in ("a", "b"):
            own = signs.select("class", "signs", "n").toDF(x, f"{x}_signs", f"{x}_n")
            pairs = pairs.join(own, x)
        alike = _agreeing(pairs, percent)
        return settle_slices(_confirmed(alike, sets, percent), "links")

    edges = linked(_central_stars(shared))
    labels = settle(components(edges), "labels")
    unsettled = settle(_unsettled(shared, labels), "unsettled")
    more = linked(settle(_rare_partners(sets, unsettled, percent), "pairs"))
    labels = components(edges.unionByName(more))

    labelled = classes.join(labels, F.col("class") == F.col("id"), "left").select(
        "class", "least", F.coalesce("label", "class").alias("label")
    )
    names = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = labelled.join(names, "label").select("class", "component_id")
    answer = rows.drop("signs").join(named, "class", "left")
    alone = F.col("class").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return answer.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        component.alias("component_id"),
        (alone | F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates, with all columns; see `near_duplicates`.

    Of repeated rows with equal id and text one stays. Rows without words all stay, but for such
    repeats.
    """
    kept = near_duplicates(docs.select("doc_id", "text"), percent).where("kept")
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("id"),
        text_hash().alias("hash"),
    )
    same = F.col("id").eqNullSafe(F.col("kept_id")) & F.col("hash").eqNullSafe(F.col("kept_hash"))
    stays = rows.join(kept.distinct(), same, "left_semi")
    return stays.dropDuplicates(["id", "hash"]).select("row.*")
