"""Spelling variants of words, joined by asymmetric q-chunks (13).

Two words that differ by one edit agree outside of it. Of two such words the shorter one (of equally
long ones, each) contributes its two disjoint halves as chunks, the other its positional grams of
the same sizes; the edit spares one of the chunks, which is then found in the other word at its own
place or shifted by one. Of the positional grams only those are written that such a chunk can meet:
the gram at the beginning, and the one at the end, for each length the shorter word may have.

A chunk that many words share, such as an ending, would make pairs of all of them. The words of such
a chunk are split again: what lies outside of the chunk holds the edit, is halved, and one of its
halves is spared too. So keys grow until few words share them, and in the end name the whole word
but for the edit, where every pair is a true one. Nothing is left out and no large group is paired.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.text import LOWER, SPACED, Words, blocks, span_hashes
from feedlake.workspace import settle

LEAST_POINTS, LEAST_COUNT = 5, 3

# One in so many runs of a document loses a code point.
SLIPS = 97

# Groups that make at most so many pairs are paired as they are; others are split by longer keys.
PAIRS = 256

# Runs of more bytes than this have their checksum taken one by one.
LONG_RUN = 64

_LETTER = np.zeros(256, bool)
_LETTER[ord("A") : ord("Z") + 1] = True
_LETTER[ord("a") : ord("z") + 1] = True


def _crc_table() -> np.ndarray:
    """The checksum's state after each byte, from state 0: eight steps of the reflected polynomial."""
    state = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        state = np.where(state & 1, np.uint32(0xEDB88320) ^ (state >> 1), state >> 1)
    return state


_CRC = _crc_table()


def checksums(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray
) -> np.ndarray:
    """crc32 of every span, continued from a checksum of what stands before it."""
    state = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    live = np.flatnonzero(ends - starts <= LONG_RUN)
    at, stop = starts[live], ends[live]
    while len(live):
        more = at < stop
        live, at, stop = live[more], at[more], stop[more]
        state[live] = _CRC[(state[live] ^ data[at]) & np.uint32(0xFF)] ^ (state[live] >> np.uint32(8))
        at = at + 1
    state ^= np.uint32(0xFFFFFFFF)
    for k in np.flatnonzero(ends - starts > LONG_RUN):
        state[k] = zlib.crc32(data[starts[k] : ends[k]], int(before[k]))
    return state


def lowered_runs(data: np.ndarray, bounds: np.ndarray) -> Words:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased.

    In UTF-8 the latter are a byte 0xC3 and the byte after it.
    """
    lead = data == 0xC3
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    return Words(np.where(inside, LOWER[data], np.uint8(0x20)), bounds, SPACED)


def counted_words(
    data: np.ndarray, bounds: np.ndarray, ids: list[str]
) -> tuple[list[str], np.ndarray]:
    """Words of a block of texts with their numbers; a word may be given more than once."""
    runs = lowered_runs(data, bounds)
    starts, ends, letters = runs.starts, runs.ends, runs.data
    heads = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
    crcs = checksums(letters, starts, ends, heads[runs.rows])
    slipped = crcs % SLIPS == 0
    points = np.concatenate([[0], np.cumsum(letters != 0xC3)])
    lengths = points[ends] - points[starts]
    plain = np.flatnonzero(~slipped & (lengths >= LEAST_POINTS))
    hashes = span_hashes(letters, starts[plain], ends[plain])
    order = np.argsort(hashes)
    fresh = np.ones(len(order), bool)
    fresh[1:] = hashes[order][1:] != hashes[order][:-1]
    first = np.flatnonzero(fresh)
    counts = np.diff(np.append(first, len(order)))
    body = letters.tobytes()
    words = [body[a:b].decode() for a, b in zip(*(x[plain[order[first]]] for x in (starts, ends)))]
    more = []
    for k in np.flatnonzero(slipped & (lengths > LEAST_POINTS)):
        run = body[starts[k] : ends[k]].decode()
        cut = int(crcs[k]) % len(run)
        more.append(run[:cut] + run[cut + 1 :])
    return words + more, np.concatenate([counts, np.ones(len(more), np.int64)])


def vocabulary(docs: DataFrame) -> DataFrame:
    """`word, n`: the words of all texts of `docs(doc_id, text)` and how often each occurs.

    A run's checksum is that of its document's id, a colon and the run; where 97 divides it, the run
    loses the code point that it names. Words have at least five code points and three occurrences.
    A null text has no words, a null id counts as an empty one, and every repeated row counts. Each
    task sums what it reads before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in blocks(batches, "text"):
            words, counts = counted_words(data, bounds, rows.column("id").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"]
            )

    named = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counted = named.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _key() -> Column:
    """What a word must share: beginning and end around the place of the edit, at equal lengths."""
    end = F.expr("right(word, after)")
    return F.xxhash64("longer", "size", "ahead", F.expr("left(word, ahead)"), "after", end)


def _split(entries: DataFrame) -> DataFrame:
    """Each entry's next two: what is known grows by the first or by the second half of the rest.

    Where one point is left and the other word has two, the point is the first or the last of them.
    """
    rest = F.col("size") - F.col("ahead") - F.col("after")
    second = F.floor(rest / 2).cast("int")
    halves = F.array(
        F.struct((F.col("ahead") + rest - second).alias("ahead"), F.col("after").alias("after")),
        F.struct(F.col("ahead"), (F.col("after") + F.greatest(second, F.lit(1))).alias("after")),
    )
    grown = entries.select("word", "n", "longer", "size", "chunk", F.inline(halves))
    return grown.withColumn("key", _key())


def _entries(words: DataFrame) -> DataFrame:
    """The chunks and grams of every word: `longer` is by how much the other word is longer."""
    size = F.char_length("word")
    kinds = F.array(
        F.struct(F.lit(0).alias("longer"), size.alias("size"), F.lit(True).alias("chunk")),
        F.struct(F.lit(1).alias("longer"), size.alias("size"), F.lit(True).alias("chunk")),
        F.struct(F.lit(1).alias("longer"), (size - 1).alias("size"), F.lit(False).alias("chunk")),
    )
    each = words.select("word", "n", F.inline(kinds)).where(F.col("size") >= LEAST_POINTS)
    return _split(each.withColumn("ahead", F.lit(0)).withColumn("after", F.lit(0)))


def _sizes(entries: DataFrame) -> DataFrame:
    """`key, longer, pairs` of all that may make pairs; equally long words are chunk and gram."""
    counted = entries.groupBy("key", "longer").agg(
        F.count("*").alias("all"), F.sum(F.col("chunk").cast("long")).alias("chunks")
    )
    pairs = F.when(F.col("longer") == 1, F.col("chunks") * (F.col("all") - F.col("chunks")))
    pairs = pairs.otherwise(F.col("all") * (F.col("all") - 1) / 2)
    return counted.select("key", "longer", pairs.alias("pairs")).where("pairs > 0")


def _paired(entries: DataFrame) -> DataFrame:
    """Pairs of words of one key that differ by one edit."""
    side = entries.select("key", "word", "n", "longer", "chunk")
    a = side.where("chunk").drop("chunk").toDF("key", "a", "n_a", "longer")
    b = side.where("not chunk or longer = 0").drop("chunk").toDF("key", "b", "n_b", "longer")
    once = (F.col("longer") == 1) | (F.col("a") < F.col("b"))
    both = a.join(b, ["key", "longer"]).where(once & (F.levenshtein("a", "b", 1) == 1))
    return both.select("a", "n_a", "b", "n_b")


def near_pairs(words: DataFrame, most: int = PAIRS) -> DataFrame:
    """`a, n_a, b, n_b`: every pair of `words(word, n)` that differ by one edit, once.

    An edit inserts, deletes or replaces one code point. Keys that make more than `most` pairs are
    split until their words agree in all but the edited place.
    """
    found = []
    # an edit that replaces leaves one point of the shorter word unknown, one that inserts leaves none
    whole = F.col("ahead") + F.col("after") + 1 - F.col("longer") >= F.col("size")
    entries = settle(_entries(words), "chunks")
    while True:
        sizes = settle(_sizes(entries), "chunk-sizes")
        sized = entries.join(sizes, ["key", "longer"])
        sized = settle(sized.withColumn("now", whole | (F.col("pairs") <= most)), "chunks")
        found.append(settle(_paired(sized.where("now")), "near"))
        large = sized.where("not now")
        if large.isEmpty():
            break
        entries = settle(_split(large), "chunks")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """`word, root` of every word of `forms(word, form)`: the last word that its forms lead to.

    A form occurs at least twice as often as its word, so there is no way back, and every round
    doubles how far a word has come.
    """
    now = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        joined = now.join(onward, F.col("root") == F.col("_at"), "left")
        step = joined.select(
            "word",
            F.coalesce("_next", "root").alias("root"),
            F.col("_next").isNotNull().alias("moved"),
        )
        step = settle(step, "roots")
        if step.where("moved").isEmpty():
            return step.drop("moved")
        now = step.drop("moved")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """`word, form, root, n, n_near, form_n` of every word of `docs`; see `vocabulary`.

    Two words are near if they differ by one edit. A word's form is the near word that occurs most
    often (of several the first in code-point order) if it occurs at least twice as often as the
    word; else it is null. The root is the last word that forms lead to, or the word itself.
    `n_near` counts near words. Without documents or words there is no row.
    """
    words = settle(vocabulary(docs), "vocabulary")
    pairs = near_pairs(words)
    both = pairs.unionByName(pairs.toDF("b", "n_b", "a", "n_a"))
    # the least of (-n, word) is the most frequent word, and of several the first
    best = settle(
        both.groupBy("a").agg(
            F.count("*").alias("n_near"),
            F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form"))).alias("best"),
        ),
        "nearest",
    )
    known = words.join(best, F.col("word") == F.col("a"), "left")
    form_n = -F.col("best.less")
    chosen = form_n >= 2 * F.col("n")
    known = settle(
        known.select(
            "word",
            F.when(chosen, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(chosen, form_n).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(known.where("form is not null")).select(F.col("word").alias("_word"), "root")
    rooted = known.join(roots, F.col("word") == F.col("_word"), "left")
    return rooted.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
