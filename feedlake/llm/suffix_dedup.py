"""Removal of repeated byte strings by suffix arrays over shards (3).

Every byte of a string of `SPAN` bytes that starts anywhere else too is removed. Sorting all
suffixes of the corpus in one place is out of the question, so windows that may be equal are first
brought together. The smallest hash of the `GRAM`-byte grams in a window depends on the window's
bytes alone; neighbouring windows mostly share it and form a run. Runs whose hash occurs once have
no repeat. The texts of the others, cut out with the bytes that their windows reach, go to shards by
hash; each shard's suffix array is induced, and suffixes whose common prefix with a neighbour is
`SPAN` long start a repeat.

Equal texts are one text that is known to occur more than once, and so are equal cut-outs; copies
cost neither sorting nor space. A hash with more distinct cut-outs than a shard should hold is not
sorted there: its windows are counted by their own hashes, over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.bitmap import bitmap, may_hold, text_hash
from feedlake.llm.suffix_arrays import common_prefixes, suffix_array
from feedlake.llm.text import blocks, mixed
from feedlake.workspace import settle

SPAN = 200
GRAM = 96
WINDOWS = SPAN - GRAM + 1

# Bytes of cut-outs in a shard.
SHARD_BYTES = 2 << 20

# 2^27 bits are 16 MB in every task.
PRINT_BITS = 27

BLOCK = 2 << 20

_BASE = 0x9E3779B97F4A7C15
_OTHER = 0xC2B2AE3D27D4EB4F
_WRAP = (1 << 64) - 1


def gram_hashes(data: np.ndarray, size: int, base: int = _BASE) -> np.ndarray:
    """Hash of every run of `size` bytes, by doubling."""
    values, span, power = data.astype(np.uint64) + np.uint64(1), 1, base
    total, done = None, 0
    while span <= size:
        if size & span:
            n = len(data) - done - span + 1
            if n <= 0:
                return np.empty(0, np.uint64)
            if total is None:
                total = values[:n].copy()
            else:
                total = total[:n] * np.uint64(power) + values[done:][:n]
            done += span
        if 2 * span <= size:
            values = values[:-span] * np.uint64(power) + values[span:]
        span, power = 2 * span, power * power & _WRAP
    return mixed(total)


def _extreme(values: np.ndarray, size: int, best) -> np.ndarray:
    span = 1
    while span < size:
        step = min(span, size - span)
        values = best(values[:-step], values[step:])
        span += step
    return values


def _runs(data: np.ndarray, bounds: np.ndarray):
    """Row, first window, number of windows, hash of every run, and whether its grams recur."""
    empty = np.empty(0, np.int64)
    if len(data) < SPAN:
        return empty, empty, empty, empty.astype(np.uint64), empty
    grams = gram_hashes(data, GRAM)
    least = _extreme(grams, WINDOWS, np.minimum)
    lengths = np.diff(bounds)
    long = np.flatnonzero(lengths >= SPAN)
    change = np.zeros(len(data) + 1, np.int8)
    change[bounds[long]] = 1
    np.add.at(change, bounds[long + 1] - SPAN + 1, -1)
    inside = np.cumsum(change, dtype=np.int8)[: len(least)] == 1
    least[~inside] = 0
    begins = inside.copy()
    begins[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    begins[bounds[long]] = True
    starts = np.flatnonzero(begins)
    if not len(starts):
        return empty, empty, empty, empty.astype(np.uint64), empty
    total = np.concatenate([[0], np.cumsum(inside)])
    counts = np.diff(np.append(total[starts], total[-1]))
    rows = np.searchsorted(bounds, starts, "right") - 1
    # grams that are the smallest of some window: a hash with two of them in one text recurs there
    edge = np.zeros(WINDOWS - 1, np.uint64)
    most = _extreme(np.concatenate([edge, least, edge]), WINDOWS, np.maximum)
    chosen = np.flatnonzero(most == grams)
    at = np.searchsorted(bounds, chosen, "right") - 1
    keys = np.sort(mixed(grams[chosen] + mixed(at.astype(np.uint64))))
    twice = keys[1:][keys[1:] == keys[:-1]]
    own = mixed(least[starts] + mixed(rows.astype(np.uint64)))
    return rows, starts - bounds[rows], counts, least[starts], np.isin(own, twice).astype(np.int64)


_RUN = "array<struct<start: bigint, windows: bigint, print: bigint, recurs: bigint>>"


def _marked(docs: DataFrame) -> DataFrame:
    """Per row: id, hash, size and digest of its text, and its runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in blocks(batches, "text", BLOCK):
            row, start, windows, prints, recurs = _runs(data, bounds)
            ends = np.searchsorted(row, np.arange(len(rows)), "right")
            parts = pa.StructArray.from_arrays(
                [pa.array(x) for x in (start, windows, prints.view(np.int64), recurs)],
                names=["start", "windows", "print", "recurs"],
            )
            lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), parts)
            digests = [
                hashlib.sha256(data[a:b]).hexdigest()
                for a, b in zip(bounds[:-1], bounds[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"), rows.column("text_hash"), pa.array(np.diff(bounds)),
                    pa.array(digests), lists,
                ],
                names=["doc_id", "text_hash", "n_bytes", "sha256", "runs"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_hash().alias("text_hash"), "text").mapInArrow(
        run, f"doc_id {kind}, text_hash string, n_bytes bigint, sha256 string, runs {_RUN}"
    )


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """`wanted(doc_id, text_hash, ...)` with the `text`; rows that repeat are taken once."""
    key = F.xxhash64("doc_id", "text_hash")
    known = bitmap(wanted.select(key.alias("h")), "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("h").to_numpy().view(np.uint64)
            yield batch.filter(pa.array(may_hold(known, hashes))).drop_columns(["h"])

    hashed = docs.select("doc_id", text_hash().alias("text_hash"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = hashed.withColumn("h", key).mapInArrow(
        run, f"doc_id {kind}, text_hash string, text string"
    )
    found = found.toDF("_doc_id", "_text_hash", "text")
    same = (wanted["text_hash"] == F.col("_text_hash")) & wanted["doc_id"].eqNullSafe(
        F.col("_doc_id")
    )
    return wanted.join(found, same).drop("_doc_id", "_text_hash")


def _cut_outs(texts: DataFrame) -> DataFrame:
    """Per run: its text's hash, where it starts, and the bytes that its windows reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                body = row["text"].encode()
                runs = row["runs"]
                bodies = [body[r["start"] : r["start"] + r["windows"] + SPAN - 1] for r in runs]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["text_hash"]] * len(runs), pa.string()),
                        pa.array([r["start"] for r in runs], pa.int64()),
                        pa.array([r["print"] for r in runs], pa.int64()),
                        pa.array([r["recurs"] for r in runs], pa.int64()),
                        pa.array([hashlib.md5(b).digest() for b in bodies], pa.binary()),
                        pa.array(bodies, pa.binary()),
                    ],
                    names=["text_hash", "start", "print", "recurs", "piece", "body"],
                )

    return texts.select("text_hash", "text", "runs").mapInArrow(
        run,
        "text_hash string, start bigint, print bigint, recurs bigint, piece binary, body binary",
    )


def _intervals(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted window starts as half-open byte intervals, one for each run of starts."""
    breaks = np.flatnonzero(np.diff(starts) > 1)
    first = starts[np.concatenate([[0], breaks + 1])]
    last = starts[np.concatenate([breaks, [len(starts) - 1]])]
    return first, last + SPAN


def repeated_windows(bodies: list[bytes]) -> list[np.ndarray]:
    """For each body, the starts of its `SPAN`-byte windows that start elsewhere in them too."""
    lengths = np.array([len(b) for b in bodies])
    # symbols 1 to 256 are bytes; 0xFF is in no text and ends each body; 0 ends all
    data = np.frombuffer(b"\xff".join(bodies) + b"\xff", np.uint8)
    symbols = np.append(data.astype(np.int16) + 1, np.int16(0))
    begins = np.cumsum(lengths + 1) - lengths - 1
    room = np.repeat(begins + lengths, lengths + 1) - np.arange(len(data))
    room = np.append(room, 0)
    order = suffix_array(symbols, 257)
    before, common = common_prefixes(symbols, order, room)
    hit = np.zeros(len(symbols), bool)
    at = np.flatnonzero(common >= SPAN)
    hit[at] = True
    hit[before[at]] = True
    places = np.flatnonzero(hit)
    cuts = np.searchsorted(places, np.append(begins, len(symbols)))
    return [places[cuts[i] : cuts[i + 1]] - begins[i] for i in range(len(bodies))]


def _sorted_shards(pieces: DataFrame, shards: int) -> DataFrame:
    """`print, piece, begin, end`: repeated bytes of each piece, from its shard's suffix array."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        found = [[], [], [], []]
        frame = frame.sort_values(["print", "piece"])
        starts = repeated_windows(frame["body"].tolist())
        for print_, piece, held in zip(frame["print"], frame["piece"], starts, strict=True):
            if len(held):
                for column, value in zip(found, _spread(print_, piece, held), strict=True):
                    column.extend(value)
        return pd.DataFrame(dict(zip(["print", "piece", "begin", "end"], found, strict=True)))

    dealt = pieces.select("print", "piece", "body").withColumn(
        "shard", F.pmod(F.xxhash64("print"), F.lit(shards))
    )
    return (
        dealt.repartition(shards, "shard")
        .groupBy("shard")
        .applyInPandas(
            lambda frame: run(frame), "print bigint, piece binary, begin bigint, end bigint"
        )
    )


def _spread(print_, piece, held):
    begin, end = _intervals(held)
    return [print_] * len(begin), [piece] * len(begin), begin, end


def _counted_windows(pieces: DataFrame) -> DataFrame:
    """The same as `_sorted_shards` for hashes with too many pieces, by counting windows."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = np.frombuffer(row["body"], np.uint8)
                high, low = gram_hashes(data, SPAN), gram_hashes(data, SPAN, _OTHER)
                n = len(high)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["print"]] * n, pa.int64()),
                        pa.array([row["piece"]] * n, pa.binary()),
                        pa.array(np.arange(n)),
                        pa.array(high.view(np.int64)),
                        pa.array(low.view(np.int64)),
                    ],
                    names=["print", "piece", "begin", "high", "low"],
                )

    each = pieces.select("print", "piece", "body").mapInArrow(
        windows, "print bigint, piece binary, begin bigint, high bigint, low bigint"
    )
    often = each.groupBy("high", "low").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    starts = each.join(often, ["high", "low"]).groupBy("print", "piece")
    starts = starts.agg(F.sort_array(F.collect_set("begin")).alias("at"))
    # one interval for each run of starts
    begins = F.expr("filter(at, (x, i) -> i = 0 or at[i - 1] < x - 1)")
    ends = F.expr("filter(at, (x, i) -> i = size(at) - 1 or at[i + 1] > x + 1)")
    spans = F.arrays_zip(begins.alias("begin"), ends.alias("last"))
    return starts.select("print", "piece", F.inline(spans)).toDF(
        "print", "piece", "begin", "last"
    ).select("print", "piece", "begin", (F.col("last") + SPAN).alias("end"))


def _cleaned(texts: DataFrame) -> DataFrame:
    """`text_hash` with size of, number of, and digest of what is left after its `spans`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                body, kept, removed, count, done = row["text"].encode(), [], 0, 0, 0
                for span in row["spans"]:
                    if span["begin"] > done or not count:
                        kept.append(body[done : span["begin"]])
                        count += 1
                        removed -= span["begin"]
                        removed += span["end"]
                    else:
                        removed += max(0, span["end"] - done)
                    done = max(done, span["end"])
                kept.append(body[done:])
                digest = hashlib.sha256(b"".join(kept)).hexdigest()
                out.append((row["text_hash"], removed, count, digest, b"".join(kept)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(c), t)
                    for c, t in zip(
                        zip(*out, strict=True) if out else [[]] * 5,
                        [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()],
                        strict=True,
                    )
                ],
                names=["cleaned_hash", "removed", "spans", "digest", "kept"],
            )

    return texts.select("text_hash", "text", "spans").mapInArrow(
        run,
        "cleaned_hash string, removed bigint, spans bigint, digest string, kept binary",
    )


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of `docs(doc_id, text)` with their text's size and digest, and repeated spans.

    The first frame has `doc_id, text_hash, n_bytes, sha256, copies` for every row, the second
    `doc_id, text_hash, spans` for each text that occurs once and holds a repeat: sorted byte spans,
    which may overlap. Of a text with several copies all bytes repeat if it has `SPAN` of them.
    """
    marked = settle(_marked(docs), "marked")
    texts = marked.where("text_hash is not null").groupBy("text_hash")
    texts = settle(texts.agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "texts")
    rows = marked.drop("runs").join(texts.drop("least"), "text_hash", "left")

    runs = marked.where(F.size("runs") > 0).select(
        "doc_id", "text_hash", F.inline("runs")
    )
    seen = runs.groupBy("print").agg((F.count("*") + F.sum("recurs")).alias("n"))
    seen = settle(seen.where("n > 1").select("print"), "prints")
    prints = bitmap(seen, "print", PRINT_BITS)

    def may_repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("runs").flatten()
            kept = may_hold(prints, parts.field("print").to_numpy().view(np.uint64))
            owner = np.repeat(np.arange(len(batch)), batch.column("runs").value_lengths())[kept]
            owner = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(owner) for c in ("doc_id", "text_hash")),
                    *parts.filter(pa.array(kept)).flatten(),
                ],
                names=["doc_id", "text_hash", "start", "windows", "print", "recurs"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    some = marked.where(F.size("runs") > 0).select("doc_id", "text_hash", "runs")
    some = some.mapInArrow(
        may_repeat,
        f"doc_id {kind}, text_hash string, start bigint, windows bigint, print bigint, "
        "recurs bigint",
    )
    some = some.join(seen, "print", "left_semi")
    # of copies of a text one is cut up
    first = texts.select(F.col("text_hash").alias("_hash"), "least", "copies")
    wanted = (
        some.groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("start", "windows", "print", "recurs")).alias("runs"))
        .join(
            first,
            (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("least")),
        )
        .select("doc_id", "text_hash", "runs", "copies")
    )
    wanted = settle(wanted, "wanted")
    cut = settle(_cut_outs(_texts(docs, wanted).dropDuplicates(["doc_id", "text_hash"])), "cut")

    distinct = (
        cut.join(wanted.where("copies > 1").select("text_hash").distinct()
                 .withColumn("copied", F.lit(1)), "text_hash", "left")
        .groupBy("print", "piece")
        .agg(
            F.first("body").alias("body"),
            F.count("*").alias("times"),
            F.max("recurs").alias("recurs"),
            F.max("copied").alias("copied"),
        )
    )
    distinct = settle(distinct, "pieces")
    sizes = distinct.groupBy("print").agg(
        F.count("*").alias("pieces"),
        F.max("recurs").alias("self"),
        F.sum(F.octet_length("body")).alias("size"),
    )
    sizes = settle(sizes.where("pieces > 1 or self > 0"), "sizes")
    small = distinct.join(sizes.where(F.col("size") <= SHARD_BYTES), "print", "left_semi")
    large = distinct.join(sizes.where(F.col("size") > SHARD_BYTES), "print", "left_semi")
    total = sizes.where(F.col("size") <= SHARD_BYTES).agg(F.sum("size")).first()[0] or 0
    shards = 1 + total // SHARD_BYTES
    known = distinct.where("times > 1 or copied = 1").select(
        "print", "piece", F.lit(0).cast("long").alias("begin"),
        F.octet_length("body").cast("long").alias("end"),
    )
    found = known.unionByName(_sorted_shards(small, shards)).unionByName(_counted_windows(large))
    found = settle(found, "repeats")
    spans = (
        cut.select("text_hash", "start", "print", "piece")
        .join(found, ["print", "piece"])
        .groupBy("text_hash")
        .agg(
            F.sort_array(
                F.collect_set(
                    F.struct(
                        (F.col("start") + F.col("begin")).alias("begin"),
                        (F.col("start") + F.col("end")).alias("end"),
                    )
                )
            ).alias("spans")
        )
    )
    once = wanted.where("copies = 1").select("doc_id", "text_hash")
    return rows, settle(once.join(spans, "text_hash"), "spans")


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row of `docs(doc_id, text)`, what is left of its text's bytes.

    Columns: `doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`; `kept` is null where no byte
    was removed. A removed stretch may begin or end inside a character, so `kept` is binary. A null
    or empty text has no bytes. Repeated rows are copies of each other.
    """
    rows, spans = repeated_spans(docs)
    cleaned = _cleaned(_texts(docs, spans))
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= SPAN)
    joined = rows.join(cleaned, F.col("text_hash") == F.col("cleaned_hash"), "left")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(b""), 256))
        .otherwise(F.coalesce("digest", "sha256"))
        .alias("kept_sha256"),
        F.when(gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )
