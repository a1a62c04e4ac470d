"""Removal of passages that an earlier document holds, by relative Lempel-Ziv parsing (12).

A word goes if a window of `SPAN` words around it also starts in a document with a smaller id. Every
document would have to be factored against every block of the corpus; but a block can only hold a
window if it holds its print, which is the smallest hash of the `GRAM`-word grams in the window.
Neighbouring windows mostly share their print and form a run. Runs whose print is in one document
alone have no copy. The others are cut out and dealt to reference blocks by print, equal ones once.

Each block is indexed by the order of all its suffixes, and every cut-out is parsed greedily into
the longest factors that an earlier document of the block holds. Factors of `SPAN` words and more
are copied. A copied window that does not begin where a factor does must cross the end of its
factor, so the matches of the last `SPAN - 1` words before each end are looked at too.

A passage that very many documents hold among different neighbours makes more cut-outs of one print
than a block should hold. Their windows are then prints of their own: every distinct window is a
block of one reference, its first occurrence, and a window that finds an earlier one there is one
factor of `SPAN` words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.bitmap import bitmap, may_hold, text_hash
from feedlake.llm.text import SPACED, Words, blocks, mixed, rolled
from feedlake.workspace import settle

SPAN = 50
GRAM = 12

# Windows of a run at most; a longer one is several.
MOST_WINDOWS = 512

# Words in a reference block.
BLOCK_WORDS = 1 << 18

# 2^27 bits are 16 MB in every task.
PRINT_BITS = 27


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of every `size` neighbouring values."""
    span = 1
    while span < size:
        step = min(span, size - span)
        values = np.minimum(values[:-step], values[step:])
        span += step
    return values


def runs(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, first window, number of windows and print of every run of the rows' windows.

    `first` has each row's first word, and one past the last. Windows are numbered by their first
    word in the row.
    """
    counts = np.diff(first)
    if len(hashes) < SPAN or counts.max(initial=0) < SPAN:
        return *[np.empty(0, np.int64)] * 3, np.empty(0, np.uint64)
    prints = _least(rolled(hashes, GRAM), SPAN - GRAM + 1)
    rows = np.repeat(np.arange(len(counts)), counts)
    inside = rows[: len(prints)] == rows[SPAN - 1 :]
    begins = inside.copy()
    begins[1:] &= (prints[1:] != prints[:-1]) | (rows[1 : len(prints)] != rows[: len(prints) - 1])
    at = np.flatnonzero(begins)
    total = np.concatenate([[0], np.cumsum(inside)])
    windows = np.diff(np.append(total[at], total[-1]))
    # long runs in parts: a part holds whole windows, so that none is lost
    parts = -(-windows // MOST_WINDOWS)
    piece = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = np.repeat(at, parts) + piece * MOST_WINDOWS
    windows = np.minimum(np.repeat(windows, parts) - piece * MOST_WINDOWS, MOST_WINDOWS)
    rows = rows[starts]
    return rows, starts - first[rows], windows, prints[starts]


_RUN = "array<struct<start: int, windows: int, print: bigint, piece: binary>>"


def _marked(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """Per row: id, text's hash, number of words, digest of all words, and runs.

    `several` is false where the text is surely none of the `copies`.
    """
    known = bitmap(copies.select(F.xxhash64("text_hash").alias("h")), "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in blocks(batches, "text"):
            words = Words(data, bounds, SPACED)
            hashes, body = words.hashes(), data.tobytes()
            row, start, windows, prints = runs(hashes, words.first)
            begin = words.first[row] + start
            pieces = [
                hashlib.md5(hashes[a:b]).digest()
                for a, b in zip(begin, begin + windows + SPAN - 1, strict=True)
            ]
            ends = np.searchsorted(row, np.arange(len(rows)), "right")
            parts = pa.StructArray.from_arrays(
                [
                    pa.array(start, pa.int32()), pa.array(windows, pa.int32()),
                    pa.array(prints.view(np.int64)), pa.array(pieces, pa.binary()),
                ],
                names=["start", "windows", "print", "piece"],
            )
            digests = [
                hashlib.sha256(b" ".join(body[a:b].split())).hexdigest()
                for a, b in zip(bounds[:-1], bounds[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"), rows.column("text_hash"),
                    pa.array(may_hold(known, rows.column("h").to_numpy().view(np.uint64))),
                    pa.array(words.counts), pa.array(digests),
                    pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), parts),
                ],
                names=["doc_id", "text_hash", "several", "n_words", "sha256", "runs"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.withColumn("h", F.xxhash64("text_hash")).mapInArrow(
        run,
        f"doc_id {kind}, text_hash string, several boolean, n_words bigint, sha256 string, "
        f"runs {_RUN}",
    )


def _later(least: str) -> Column:
    """Does a document with a smaller id hold it? A document without id follows all others."""
    unnamed = F.col("doc_id").isNull() & F.col(least).isNotNull()
    return F.coalesce(F.col("doc_id") > F.col(least), unnamed)


def _shared_runs(marked: DataFrame, copies: DataFrame) -> DataFrame:
    """`doc_id, text_hash, start, windows, print, piece`: runs whose print several documents hold.

    Of the `copies` of a text only those with the first id count.
    """
    having = marked.where(F.size("runs") > 0)
    several = having.where("several").join(copies, "text_hash", "left").where(~_later("first_id"))
    apart = having.where("not several").unionByName(several.drop("first_id"))
    apart = apart.select("doc_id", "text_hash", "runs")
    each = apart.select("doc_id", F.explode("runs.print").alias("print"))
    held = each.groupBy("print").agg(
        F.min("doc_id").alias("least"),
        F.max("doc_id").alias("most"),
        (F.count("*") - F.count("doc_id")).alias("unnamed"),
    )
    held = held.where("least < most or (least is not null and unnamed > 0)").select("print")
    held = settle(held, "prints")
    known = bitmap(held, "print", PRINT_BITS)

    def may_be_held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("runs")
            parts = lists.flatten()
            kept = may_hold(known, parts.field("print").to_numpy().view(np.uint64))
            owner = pa.array(np.repeat(np.arange(len(batch)), lists.value_lengths())[kept])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(owner) for c in ("doc_id", "text_hash")),
                    *parts.filter(pa.array(kept)).flatten(),
                ],
                names=["doc_id", "text_hash", "start", "windows", "print", "piece"],
            )

    kind = marked.schema["doc_id"].dataType.simpleString()
    some = apart.mapInArrow(
        may_be_held,
        f"doc_id {kind}, text_hash string, start int, windows int, print bigint, piece binary",
    )
    return some.join(held, "print", "left_semi")


def _own() -> Column:
    """One key of a row's id and text; as parts of a struct, ids that are null are equal."""
    return F.struct("doc_id", "text_hash").alias("own")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """`wanted(own, ...)` with `doc_id`, `text_hash` and `text`."""
    known = bitmap(wanted.select(F.xxhash64("own").alias("h")), "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("h").to_numpy().view(np.uint64)
            yield batch.filter(pa.array(may_hold(known, hashes))).drop_columns(["h"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.withColumn("h", F.xxhash64(_own())).mapInArrow(
        run, f"doc_id {kind}, text_hash string, text string"
    )
    return wanted.join(found.withColumn("own", _own()), "own")


def _cut_outs(texts: DataFrame) -> DataFrame:
    """`print, piece, large, doc_id, body`: the words that windows of each of a text's `cuts` reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                words = batch.column("text")[i].as_py().encode().split()
                cuts = batch.column("cuts")[i].values
                starts, windows = (cuts.field(c).to_pylist() for c in ("start", "windows"))
                bodies = [
                    b" ".join(words[a : a + n + SPAN - 1])
                    for a, n in zip(starts, windows, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        cuts.field("print"), cuts.field("piece"), cuts.field("large"),
                        batch.column("doc_id").take(pa.array(np.full(len(cuts), i))),
                        pa.array(bodies, pa.binary()),
                    ],
                    names=["print", "piece", "large", "doc_id", "body"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "text", "cuts").mapInArrow(
        run, f"print bigint, piece binary, large boolean, doc_id {kind}, body binary"
    )


class Index:
    """The suffixes of a sequence in order; classes of equal 1, 2, 4, ... words by doubling."""

    def __init__(self, symbols: np.ndarray, deepest: int):
        """`deepest` is the length of the longest match that is possible."""
        ranks = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
        self.levels, span, n = [ranks], 1, len(ranks)
        while span <= deepest and ranks.max(initial=0) < n - 1:
            after = np.zeros(n, np.int64)
            after[: n - span] = ranks[span:] + 1
            ranks = np.unique(ranks * (n + 1) + after, return_inverse=True)[1]
            self.levels.append(ranks)
            span *= 2
        self.order = np.argsort(ranks, kind="stable")

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words the suffixes at `a` and at `b` have in common."""
        a, b, length = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        n = len(self.order)
        for level in reversed(range(len(self.levels))):
            live = np.flatnonzero((a < n) & (b < n))
            ranks = self.levels[level]
            live = live[ranks[a[live]] == ranks[b[live]]]
            for x in (a, b, length):
                x[live] += 1 << level
        return length

    def longest_earlier(self, owners: np.ndarray) -> np.ndarray:
        """For every place, the longest match with a place of a smaller owner.

        In the order of suffixes the match is with the nearest suffix of a smaller owner on either
        side. All look for theirs at once: who is not smaller passes on where it got to itself.
        """
        best = np.zeros(len(self.order), np.int64)
        neighbours = self.common(self.order[:-1], self.order[1:])
        for order, next_to in ((self.order, neighbours), (self.order[::-1], neighbours[::-1])):
            own = owners[order]
            shared = np.concatenate([[0], next_to])
            to = np.arange(len(order)) - 1
            live = np.flatnonzero(shared > 0)
            while True:
                live = live[shared[live] > 0]
                live = live[own[to[live]] >= own[live]]
                if not len(live):
                    break
                at = to[live]
                shared[live] = np.minimum(shared[live], shared[at])
                to[live] = to[at]
            best[order] = np.maximum(best[order], shared)
        return best


def factors(matches: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the greedy factors of the pieces `begins:ends` start, given all longest matches.

    A word without match is a factor of its own. The parses of all pieces advance together: the
    places reached in 2^k steps reach others with the steps taken twice.
    """
    n = len(matches)
    step = np.arange(n + 1)
    step[:n] += np.maximum(matches, 1)
    step[ends] = ends
    reached = np.zeros(n + 1, bool)
    reached[begins] = True
    while True:
        before = np.count_nonzero(reached)
        reached[step[np.flatnonzero(reached)]] = True
        if np.count_nonzero(reached) == before:
            break
        step = step[step]
    reached[ends] = False
    return np.flatnonzero(reached[:n])


def copied(bodies: list[bytes], owners: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each body of words, bounds of the stretches whose windows an earlier owner's body holds."""
    joined = b"\n".join(bodies)
    sizes = np.array([len(b) for b in bodies], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
    bounds[-1] -= 1
    words = Words(np.frombuffer(joined, np.uint8), bounds, SPACED)
    ids = np.unique(words.hashes(), return_inverse=True)[1]
    counts = words.counts
    # a symbol of its own after each body, so that no match goes beyond it
    begins = words.first[:-1] + np.arange(len(bodies))
    ends = begins + counts
    symbols = np.empty(len(ids) + len(bodies), np.int64)
    inside = np.ones(len(symbols), bool)
    inside[ends] = False
    symbols[inside] = ids
    symbols[ends] = len(ids) + np.arange(len(bodies))
    owner = np.repeat(owners, counts + 1)
    matches = Index(symbols, int(counts.max())).longest_earlier(owner)
    matches[ends] = 0
    starts = factors(matches, begins, ends)
    stops = np.sort(np.concatenate([starts, ends]))  # where factors end, each but the first of all
    # long factors, and long matches that begin inside a factor and cross its end
    places = np.flatnonzero(matches >= SPAN)
    is_start = np.zeros(len(symbols), bool)
    is_start[starts] = True
    next_stop = stops[np.searchsorted(stops, places, "right")]
    places = places[is_start[places] | (next_stop - places < SPAN)]
    change = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(change, places, 1)
    np.add.at(change, places + matches[places], -1)
    covered = np.concatenate([[False], np.cumsum(change)[:-1] > 0, [False]])
    edges = np.diff(covered.astype(np.int8))
    up, down = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    cuts = np.searchsorted(up, np.append(begins, len(symbols)))
    return [
        (up[a:b] - begin, down[a:b] - begin)
        for a, b, begin in zip(cuts[:-1], cuts[1:], begins, strict=True)
    ]


def _parsed(cut: DataFrame, shards: int) -> DataFrame:
    """`print, piece, begin, end`: copied stretches of the cut-outs, block by block."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["print", "piece"])
        ranks = frame["doc_id"].rank(method="dense", na_option="bottom").to_numpy(np.int64)
        found = copied(frame["body"].tolist(), ranks)
        sizes = [len(begin) for begin, _ in found]
        at = np.repeat(np.arange(len(frame)), sizes)
        begin, end = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        return pd.DataFrame(
            {
                "print": frame["print"].to_numpy()[at], "piece": frame["piece"].to_numpy()[at],
                "begin": begin, "end": end,
            }
        )

    shard = F.pmod(F.xxhash64("print"), F.lit(shards)).alias("shard")
    dealt = cut.select("print", "piece", "doc_id", "body", shard)
    return dealt.groupBy("shard").applyInPandas(
        lambda frame: run(frame), "print bigint, piece binary, begin bigint, end bigint"
    )


def _single_windows(cut: DataFrame) -> DataFrame:
    """The same as `_parsed` for prints with more cut-outs than a block holds."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                body = np.frombuffer(batch.column("body")[i].as_buffer(), np.uint8)
                hashes = Words(body, np.array([0, len(body)]), SPACED).hashes()
                high, low = rolled(hashes, SPAN), rolled(mixed(hashes + np.uint64(1)), SPAN)
                at = pa.array(np.full(len(high), i))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(at) for c in ("print", "piece", "doc_id")),
                        pa.array(np.arange(len(high))),
                        pa.array(high.view(np.int64)), pa.array(low.view(np.int64)),
                    ],
                    names=["print", "piece", "doc_id", "begin", "high", "low"],
                )

    kind = cut.schema["doc_id"].dataType.simpleString()
    each = cut.select("print", "piece", "doc_id", "body").mapInArrow(
        windows,
        f"print bigint, piece binary, doc_id {kind}, begin bigint, high bigint, low bigint",
    )
    first = each.groupBy("high", "low").agg(F.min("doc_id").alias("least"))
    late = each.join(settle(first, "windows"), ["high", "low"]).where(_later("least"))
    return late.select("print", "piece", "begin", (F.col("begin") + SPAN).alias("end"))


def copied_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of `docs(doc_id, text, text_hash)` with digests, and the copied spans of words.

    The first frame has `doc_id, text_hash, n_words, sha256, copied` for every row; `copied` says
    that a row with a smaller id has the same text. The second has `own, spans` for the others that
    hold copied windows: `own` has the row's id and text's hash, and `spans` are sorted spans of
    words, which may overlap.
    """
    same = docs.groupBy("text_hash").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    copies = settle(same.where("n > 1").drop("n"), "copies")
    marked = settle(_marked(docs, copies), "marked")
    rows = marked.drop("runs", "several").join(copies, "text_hash", "left")
    rows = rows.withColumn("copied", _later("first_id")).drop("first_id")

    shared = settle(_shared_runs(marked, copies), "shared")
    home = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "start", "windows")
    pieces = settle(shared.groupBy("print", "piece").agg(F.min(home).alias("home")), "pieces")
    groups = pieces.groupBy("print").agg(
        F.count("*").alias("pieces"), F.sum(F.col("home.windows") + SPAN).alias("size")
    )
    groups = settle(groups.where("pieces > 1").drop("pieces"), "groups")
    large = F.col("size") > BLOCK_WORDS
    shards = 1 + (groups.where(~large).agg(F.sum("size")).first()[0] or 0) // BLOCK_WORDS
    homes = pieces.join(groups, "print").select("home.*", "print", "piece", large.alias("large"))
    wanted = homes.groupBy(_own()).agg(
        F.collect_list(F.struct("start", "windows", "print", "piece", "large")).alias("cuts")
    )
    cut = settle(_cut_outs(_texts(docs, settle(wanted, "wanted"))), "cut")
    parsed = settle(_parsed(cut.where("not large"), shards), "parsed")
    parsed = parsed.unionByName(settle(_single_windows(cut.where("large")), "parsed"))
    parsed = parsed.groupBy("print", "piece").agg(
        F.collect_list(F.struct("begin", "end")).alias("inner")
    )
    # who holds a piece later has all of it copied, who holds it first what its parse found
    answers = pieces.select("print", "piece", F.col("home.doc_id").alias("least")).join(
        parsed, ["print", "piece"], "left"
    )
    answers = settle(answers, "answers")
    reach = (F.col("windows") + SPAN - 1).cast("long")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), reach.alias("end")))
    inner = F.when(_later("least"), whole).otherwise(F.col("inner"))
    placed = F.transform(
        inner,
        lambda s: F.struct(
            (s["begin"] + F.col("start")).alias("begin"), (s["end"] + F.col("start")).alias("end")
        ),
    )
    spans = (
        shared.join(answers, ["print", "piece"])
        .select("doc_id", "text_hash", placed.alias("spans"))
        .where("spans is not null")
        .groupBy(_own())
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"))
    )
    return rows, settle(spans, "spans")


def _cleaned(texts: DataFrame) -> DataFrame:
    """`own` with the number of words in `spans` and what is left without them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept, digests = [], [], []
            for i in range(len(batch)):
                words, left, done = batch.column("text")[i].as_py().encode().split(), [], 0
                spans = batch.column("spans")[i].values
                bounds = (spans.field(c).to_pylist() for c in ("begin", "end"))
                for begin, end in zip(*bounds, strict=True):
                    left += words[done:begin]
                    done = max(done, end)
                left += words[done:]
                body = b" ".join(left)
                removed.append(len(words) - len(left))
                kept.append(body.decode())
                digests.append(hashlib.sha256(body).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("own"), pa.array(removed, pa.int64()), pa.array(digests, pa.string()),
                    pa.array(kept, pa.large_string()).cast(pa.string()),
                ],
                names=["own", "removed", "digest", "kept"],
            )

    own = texts.schema["own"].dataType.simpleString()
    return texts.select("own", "text", "spans").mapInArrow(
        run, f"own {own}, removed bigint, digest string, kept string"
    )


def without_copied_passages(docs: DataFrame) -> DataFrame:
    """Per row of `docs(doc_id, text)`, what is left of its words.

    Columns: `doc_id, n_words, n_removed, kept_sha256, kept`: the words that stay, joined by one
    space; `kept` is null where none was removed. A null or empty text has no words. A row without id
    follows all others. Rows that share an id are one document: none of them is earlier. A text of
    fewer than `SPAN` words has no window and stays.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("text_hash", text_hash()).select("doc_id", "text_hash", "text")
    rows, spans = copied_spans(texts)
    cleaned = settle(_cleaned(_texts(texts, spans).dropDuplicates(["own"])), "cleaned")
    joined = rows.withColumn("own", _own()).join(cleaned, "own", "left")
    gone = F.col("copied") & (F.col("n_words") >= SPAN)
    return joined.select(
        "doc_id",
        "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.sha2(F.lit(b""), 256))
        .otherwise(F.coalesce("digest", "sha256"))
        .alias("kept_sha256"),
        F.when(gone, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )
