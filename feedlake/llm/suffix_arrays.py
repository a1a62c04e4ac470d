"""Suffix arrays by induced sorting, and permuted common prefixes, with numpy sweeps.

The order is right as far as `DEPTH` symbols: suffixes that agree that far may come in any order
among themselves, which is all that repeats of up to `DEPTH` symbols need.
"""

from __future__ import annotations

import numpy as np

DEPTH = 256

# Alphabets above this are not swept bucket by bucket.
SWEPT = 1024


def smaller_types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one. The last symbol is a smallest one of its own."""
    n = len(text)
    differs = np.flatnonzero(text[:-1] != text[1:])
    # each position is decided by the next place where neighbours differ
    at = differs[np.searchsorted(differs, np.arange(n - 1))]
    return np.append(text[at] < text[at + 1], True)


def _deal(order, heads, text, found, step):
    """Place `found`, in this order, from their buckets' heads on, upwards or downwards."""
    chars = text[found]
    by = np.argsort(chars, kind="stable")
    chars, found = chars[by], found[by]
    counts = np.bincount(chars, minlength=len(heads))
    rank = np.arange(len(found)) - np.repeat(np.cumsum(counts) - counts, counts)
    order[heads[chars] + step * rank] = found
    heads += step * counts


def induced(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, size: int) -> np.ndarray:
    """All suffixes, sorted by what the order of the leftmost-smaller ones `leftmost` induces.

    A bucket's suffixes are taken in waves: those that earlier buckets placed there, then those that
    these place in the same bucket, and so on.
    """
    counts = np.bincount(text, minlength=size)
    ends = np.cumsum(counts)
    begins = ends - counts
    order = np.full(len(text), -1, np.int64)

    per_bucket = np.bincount(text[leftmost], minlength=size)
    seeds = leftmost[np.argsort(text[leftmost], kind="stable")]
    seed_ends = np.cumsum(per_bucket)

    heads = begins.copy()
    for c in np.flatnonzero(counts):
        done = begins[c]
        while done < heads[c]:
            wave, done = order[done : heads[c]], heads[c]
            before = wave[wave > 0] - 1
            before = before[~smaller[before]]
            if len(before):
                _deal(order, heads, text, before, 1)
        wave = seeds[seed_ends[c] - per_bucket[c] : seed_ends[c]]
        before = wave[wave > 0] - 1
        before = before[~smaller[before]]
        if len(before):
            _deal(order, heads, text, before, 1)

    larger_ends = heads.copy()
    tails = ends - 1
    for c in np.flatnonzero(counts)[::-1]:
        done = ends[c] - 1
        while done > tails[c]:
            wave, done = order[tails[c] + 1 : done + 1][::-1], tails[c]
            before = wave[wave > 0] - 1
            before = before[smaller[before]]
            if len(before):
                _deal(order, tails, text, before, -1)
        wave = order[begins[c] : larger_ends[c]][::-1]
        before = wave[wave > 0] - 1
        before = before[smaller[before]]
        if len(before):
            _deal(order, tails, text, before, -1)
    order[0] = len(text) - 1  # the last symbol, which nothing induces
    return order


def _names(text, smaller, sorted_leftmost, leftmost) -> tuple[np.ndarray, int]:
    """Names of the leftmost-smaller substrings in text order, equal for equal ones."""
    at = np.searchsorted(leftmost, sorted_leftmost)
    lengths = np.diff(np.append(leftmost, len(text) - 1)) + 1
    size = lengths[at]
    same = size[1:] == size[:-1]
    live, step = np.flatnonzero(same), 0
    while len(live):
        a, b = sorted_leftmost[live] + step, sorted_leftmost[live + 1] + step
        equal = (text[a] == text[b]) & (smaller[a] == smaller[b])
        same[live[~equal]] = False
        step += 1
        live = live[equal]
        live = live[size[live] > step]
    names = np.concatenate([[0], np.cumsum(~same)])
    result = np.empty(len(leftmost), np.int64)
    result[at] = names
    return result, int(names[-1]) + 1


def _doubled(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of `names`, by doubling the number of names that are compared.

    Each name spans two symbols or more, so `DEPTH / 2` names are enough.
    """
    rank = names.copy()
    order = np.argsort(rank, kind="stable")
    span = 1
    while span < DEPTH // 2:
        held = rank[order]
        first = np.append(True, held[1:] != held[:-1])
        start = np.flatnonzero(first)
        tied = np.repeat(np.diff(np.append(start, len(order))) > 1, np.diff(np.append(start, len(order))))
        if not tied.any():
            break
        # ranks count the smaller suffixes, so that re-sorting a tie leaves all other ranks as they are
        rank[order] = np.repeat(start, np.diff(np.append(start, len(order))))
        live = order[tied]
        following = np.zeros(len(live), np.int64)
        inside = live + span < len(rank)
        following[inside] = rank[live[inside] + span] + 1
        by = np.lexsort((following, rank[live]))
        live, following = live[by], following[by]
        place = np.flatnonzero(tied)
        order[place] = live
        new = np.append(
            True, (rank[live][1:] != rank[live][:-1]) | (following[1:] != following[:-1])
        )
        rank[live] = place[np.maximum.accumulate(np.where(new, np.arange(len(live)), 0))]
        span *= 2
    return order


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """Sorted suffixes of `text`, whose last symbol is 0 and occurs nowhere else; symbols < `size`."""
    if len(text) == 1:
        return np.zeros(1, np.int64)
    smaller = smaller_types(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    order = induced(text, smaller, leftmost, size)
    mark = np.zeros(len(text), bool)
    mark[leftmost] = True
    in_order = order[mark[order]]
    names, different = _names(text, smaller, in_order, leftmost)
    if different < len(leftmost):
        # the last name is the last symbol's and the smallest: the shorter text is one of the kind
        reduced = suffix_array(names, different) if different <= SWEPT else _doubled(names)
        in_order = leftmost[reduced]
    return induced(text, smaller, in_order, size)


def common_prefixes(text: np.ndarray, order: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every position, the suffix before it in order, and how much both have in common.

    At most `room` symbols count, which must fall by one from each position to the next or start
    anew. Where a position and the one before it in the text are preceded, in order, by neighbours
    in the text too, and these begin alike, the common prefix is the last position's without its
    first symbol. Values are compared only elsewhere.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    follows = (before[1:] > 0) & (before[1:] - 1 == before[:-1])
    follows &= text[:-1] == text[before[1:] - 1]
    own = np.append(True, ~follows | (room[1:] + 1 != room[:-1]))
    common = np.zeros(n, np.int64)
    live = np.flatnonzero(own & (before >= 0) & (room > 0))
    padded = np.concatenate([text.astype(np.uint8), np.zeros(8, np.uint8)])
    eight = np.ndarray(len(text) + 1, "<u8", padded, strides=(1,))
    length = 0
    while len(live):
        a, b = live + length, before[live] + length
        inside = np.minimum(a, b) < len(text)
        inside &= np.maximum(a, b) < len(text)
        live, a, b = live[inside], a[inside], b[inside]
        apart = eight[a] ^ eight[b]
        lowest = apart & (~apart + np.uint64(1))
        same = np.where(apart == 0, 8, np.log2(np.maximum(lowest, 1).astype(float)).astype(int) // 8)
        common[live] = length + same
        live = live[(apart == 0) & (room[live] > length + 8)]
        length += 8
    common = np.minimum(common, room)
    last = np.maximum.accumulate(np.where(own, np.arange(n), 0))
    return before, np.maximum(common[last] - (np.arange(n) - last), 0)
