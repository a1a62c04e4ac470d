import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from feedlake.llm import suffix_arrays, suffix_dedup
from feedlake.llm.suffix_arrays import common_prefixes, suffix_array
from feedlake.llm.suffix_dedup import SPAN, repeated_windows, without_repeats


@pytest.mark.parametrize("swept", [0, 1024])
def test_suffix_arrays_and_common_prefixes(monkeypatch, swept):
    monkeypatch.setattr(suffix_arrays, "SWEPT", swept)
    rng = random.Random(5)
    for _ in range(150):
        kinds = rng.choice([1, 2, 3, 20])
        body = [rng.randint(1, kinds) for _ in range(rng.randint(1, 120))]
        body = body[: max(1, len(body) // 5)] * 5 if rng.random() < 0.4 else body
        text = np.array([*body, 0])
        order = suffix_array(text, kinds + 1)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        room = np.arange(len(text))[::-1].copy()
        before, common = common_prefixes(text, order, room)
        for a, b in zip(order[:-1], order[1:]):
            size = next(k for k in range(len(text)) if text[a + k : a + k + 1] != text[b + k])
            assert before[b] == a and common[b] == min(size, room[b])


def expected(docs):
    bodies = [(t or "").encode() for _, t in docs]
    seen = Counter(b[i : i + SPAN] for b in bodies for i in range(len(b) - SPAN + 1))
    result = []
    for (doc, _), body in zip(docs, bodies):
        gone = bytearray(len(body))
        for i in range(len(body) - SPAN + 1):
            if seen[body[i : i + SPAN]] > 1:
                gone[i : i + SPAN] = b"\1" * SPAN
        kept = bytes(b for b, g in zip(body, gone) if not g)
        spans = len([part for part in bytes(gone).split(b"\0") if part])
        digest = hashlib.sha256(kept).hexdigest()
        result.append((doc, len(body), sum(gone), spans, digest))
    return sorted(result, key=str)


def corpus(seed):
    rng = random.Random(seed)

    def text(n):
        return "".join(rng.choice("abcdé ") for _ in range(n))

    passages = [text(n) for n in (199, 200, 201, 300, 900, 40)]
    docs = [(i, "".join(text(rng.randint(0, 400)) + rng.choice(passages) for _ in range(3)))
            for i in range(60)]
    base = text(2000)
    for i in range(25):
        at = rng.randrange(2000)
        docs.append((100 + i, base[:at] + "#" + base[at + 1 :]))
    docs += [(200, "x" * 199), (201, "y" * 200), (202, "z" * 201), (203, "ab" * 600)]
    docs += [(204, text(700) * 2), (205, None), (206, ""), (207, "é" * 100)]
    docs += [(210 + i, passages[4]) for i in range(3)] + [(210, passages[4]), (220, "short")]
    return docs


@pytest.mark.parametrize("shard", [2 << 20, 600])
def test_what_is_left_is_what_brute_force_leaves(spark, monkeypatch, shard):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    docs = corpus(shard)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    rows = without_repeats(frame).drop("kept").collect()
    assert sorted(map(tuple, rows), key=str) == expected(docs)


def test_small_bitmaps_and_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PRINT_BITS", 7)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 500)
    docs = corpus(3)[40:]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = without_repeats(frame).drop("kept").collect()
    assert sorted(map(tuple, rows), key=str) == expected(docs)


def test_tails_that_repeat_only_in_themselves(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1)  # each row ends a block of its own
    rng = random.Random(11)
    docs = []
    for period in range(2, 105):
        for more in sorted({0, period - 2}):
            unit = "".join(rng.choice("abcdefghijklmnop") for _ in range(period))
            head = "".join(rng.choice("qrstuvwxyz") for _ in range(rng.choice([0, 1, 150, 400])))
            docs.append((len(docs), head + (unit * 300)[: SPAN + period + more]))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    rows = without_repeats(frame).drop("kept").collect()
    assert sorted(map(tuple, rows), key=str) == expected(docs)


def test_repeated_windows_of_many_bodies():
    a, b = b"p" * 50 + b"q" * 160, b"r" * 5 + b"p" * 50 + b"q" * 160
    starts = repeated_windows([a, b, b"s" * 230, b"t"])
    assert [s.tolist() for s in starts] == [list(range(11)), list(range(5, 16)), list(range(31)), []]


def test_awkward_rows(awkward, empty):
    rows = {r.doc_id: r for r in without_repeats(awkward).collect()}
    assert rows[1].n_bytes == rows[2].n_bytes == 0 and rows[6].n_removed == 0
    assert rows[4].n_removed == 0  # copies of fewer bytes than a span
    assert without_repeats(awkward.union(awkward)).where("doc_id = 6").first().n_spans == 1
    assert without_repeats(empty).count() == 0
