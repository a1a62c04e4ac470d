"""Packing of documents into fixed windows by best-fit decreasing (1).

A document is its token ids and an end id. It is first cut into full windows; what remains is
shorter than a window. Remainders go, longest first, into the open window with the least room that
still holds them, which a segment tree over remaining room finds. Remainders are dealt to shards of
bounded size by their row number, so that one document, source or length that holds much of the
rows cannot fill a shard; each shard is packed alone.

At the end of a shard some windows stay rather empty. Those padded by more than `LOOSE` of the
window are undone, and each of their pieces is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.text import blocks, row_numbers, settle_slices
from feedlake.llm.tokens import word_encoder

# Bytes of text whose words are held as Python strings at a time.
BLOCK_BYTES = 1 << 20

WINDOW = 4096
END_ID = 2

# Pieces that one task packs.
SHARD_PIECES = 50_000

# Share of padding above which a window is undone.
LOOSE = 1 / 16


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, ids: bool = False) -> DataFrame:
    """Every document cut into full windows and a remainder.

    Columns: `row` (numbers the piece), `doc_id, start, length, doc_tokens`, the piece's `crc32`
    and those of its cut into powers of two, largest first, as `parts`; with `ids`, the piece's
    token ids as unsigned little-endian 32-bit numbers. A null or empty text is its end id.
    """
    names = ["row", "doc_id", "start", "length", "doc_tokens", "crc32", "parts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, done = word_encoder(tokenizer), 0
        for rows, data, bounds in blocks(batches, "text", BLOCK_BYTES):
            owner, starts, lengths, totals, crcs, parts, bodies = [], [], [], [], [], [], []
            for i, body in enumerate(encoder.encode(data, bounds)):
                body = np.append(body, np.uint32(END_ID))
                for start in range(0, len(body), window):
                    piece = body[start : start + window]
                    raw = piece.tobytes()
                    owner.append(i)
                    starts.append(start)
                    lengths.append(len(piece))
                    totals.append(len(body))
                    crcs.append(zlib.crc32(raw))
                    cuts = powers(len(piece)) if len(piece) < window else []
                    parts.append([zlib.crc32(raw[4 * a : 4 * b]) for a, b in cuts])
                    bodies.append(raw)
            columns = [
                pa.array(row_numbers(done, len(owner))),
                rows.column("doc_id").take(pa.array(owner, pa.int64())),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(totals, pa.int64()),
                pa.array(crcs, pa.int64()),
                pa.array(parts, pa.list_(pa.int64())),
            ]
            if ids:
                columns.append(pa.array(bodies, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names + ["ids"] * ids)
            done += len(owner)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"row bigint, doc_id {kind}, start bigint, length bigint, doc_tokens bigint, "
        "crc32 bigint, parts array<bigint>" + ", ids binary" * ids,
    )


def powers(length: int) -> list[tuple[int, int]]:
    """`[0, length)` cut into powers of two, largest first."""
    cuts, start = [], 0
    for bit in reversed(range(length.bit_length())):
        if length >> bit & 1:
            cuts.append((start, start + (1 << bit)))
            start += 1 << bit
    return cuts


class RoomTree:
    """Which amounts of room some open window has; finds the least that is enough."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.held = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, window: int) -> None:
        self.open[room].append(window)
        self._count(room, 1)

    def _count(self, room: int, change: int) -> None:
        node = self.size + room
        while node:
            self.held[node] += change
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Room and number of the tightest window with at least `least` room, removed."""
        node = self.size + least
        if not self.held[node]:
            while node > 1 and (node & 1 or not self.held[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.held[2 * node] else 2 * node + 1
        room = node - self.size
        self._count(room, -1)
        return room, self.open[room].pop()


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of every length, by best-fit decreasing."""
    number, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    tree, opened = RoomTree(window), 0
    for i in np.argsort(-lengths, kind="stable"):
        length = int(lengths[i])
        room, at = tree.take(length) or (window, opened)
        opened += at == opened
        number[i], offset[i] = at, window - room
        if room > length:
            tree.add(room - length, at)
    return number, offset


def _pack(frame: pd.DataFrame, window: int, loose: float) -> pd.DataFrame:
    frame = frame.sort_values("row", ignore_index=True)
    number, offset = best_fit(frame["length"].to_numpy(), window)
    frame["sequence"], frame["offset"] = number, offset
    fill = np.bincount(number, weights=frame["length"])
    odd = (window - fill > loose * window) & (fill.astype(int) & (fill.astype(int) - 1) != 0)
    undone = odd[number]
    whole, rest, following = frame[~undone], [], len(fill)
    for piece in frame[undone].itertuples(index=False):
        for (start, end), crc in zip(powers(piece.length), piece.parts, strict=True):
            rest.append(
                piece._replace(
                    start=piece.start + start,
                    length=end - start,
                    crc32=crc,
                    sequence=following,
                    offset=0,
                )
            )
            following += 1
    packed = pd.concat([whole, pd.DataFrame(rest, columns=frame.columns)]) if rest else whole
    return packed.drop(columns=["parts", "row"])


def pack(found: DataFrame, window: int = WINDOW, loose: float = LOOSE) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`: which window each lies in, and where.

    Offsets of a window have no gap. Pieces may be cut further, into powers of two; every token
    stays in exactly one. Equal lengths are taken in row order. Empty input gives no rows.
    """
    found = settle_slices(found, "pieces")
    full = found.where(F.col("length") == window).select(
        "doc_id", "start", "length", "doc_tokens", "crc32",
        (2 * F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    rest = found.where(F.col("length") < window)
    shards = max(1, -(-rest.count() // SHARD_PIECES))
    dealt = rest.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))

    columns = full.columns

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        packed = _pack(frame.drop(columns="shard"), window, loose)
        packed["sequence_id"] = 2 * (packed.pop("sequence") * shards + key[0]) + 1
        return packed[columns]

    return full.unionByName(dealt.groupBy("shard").applyInPandas(run, full.schema))
