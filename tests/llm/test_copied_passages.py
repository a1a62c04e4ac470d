import hashlib
import random
import re

import numpy as np
import pytest

from feedlake.llm import copied_passages
from feedlake.llm.copied_passages import SPAN, Index, copied, factors, without_copied_passages
from feedlake.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def covered(rows):
    """For each row (doc_id, text), its words and which of them go."""
    split = [WORD.findall(text or "") for _, text in rows]
    first = {}
    for (doc_id, _), words in zip(rows, split, strict=True):
        key = float("inf") if doc_id is None else doc_id
        for i in range(len(words) - SPAN + 1):
            window = tuple(words[i : i + SPAN])
            first[window] = min(first.get(window, key), key)
    out = []
    for (doc_id, _), words in zip(rows, split, strict=True):
        key = float("inf") if doc_id is None else doc_id
        gone = [False] * len(words)
        for i in range(len(words) - SPAN + 1):
            if first[tuple(words[i : i + SPAN])] < key:
                gone[i : i + SPAN] = [True] * SPAN
        out.append((words, gone))
    return out


def brute_force(rows):
    want = []
    for (doc_id, _), (words, gone) in zip(rows, covered(rows), strict=True):
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        digest = hashlib.sha256(kept.encode()).hexdigest()
        want.append((doc_id, len(words), sum(gone), digest, kept if any(gone) else None))
    return sorted(want, key=repr)


def found(df):
    return sorted(
        ((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in df.collect()), key=repr
    )


def corpus(seed=7, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "日本", "ß", " ", "\x1c"]
    passages = [rng.choices(vocabulary, k=k) for k in (49, 50, 51, 70, 130, 600)]
    passages += [["a"] * 120, ["a", "b"] * 60, ["x", "y", "z"] * 30]
    rows = []
    for doc_id in rng.sample(range(1000), n):
        words = []
        for _ in range(rng.randint(0, 5)):
            part = rng.choice(passages)
            a, b = sorted(rng.sample(range(len(part) + 1), 2))
            words += rng.choices(vocabulary, k=rng.randint(0, 30)) + rng.choice([part, part[a:b]])
        rows.append((doc_id, rng.choice([" ", "\n", "\t \x0b"]).join(words)))
    rows += [(2000 + i, rows[i][1]) for i in range(6)]
    rows += [(None, rows[2][1]), (None, " ".join(passages[4])), (3000, None), (3001, "")]
    # one document that repeats a passage of its own, and rows that share an id
    own = " ".join(rng.choices(vocabulary, k=80))
    return rows + [(3002, f"{own} x {own}"), (3003, own), (3003, own + " end"), (3003, own)]


@pytest.mark.parametrize("most", [copied_passages.BLOCK_WORDS, 400, 1])
def test_equals_brute_force(spark, monkeypatch, most):
    """With blocks of one word, all windows of shared prints are blocks of their own."""
    monkeypatch.setattr(copied_passages, "BLOCK_WORDS", most)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    want = brute_force(rows)
    assert sum(0 < w[2] < w[1] for w in want) > 20
    assert found(without_copied_passages(docs)) == want


def test_long_runs_are_cut(spark):
    """A text of one repeated word has one print; its run is longer than a piece may be."""
    rows = [(1, "a " * 3000), (2, "b " + "a " * 2000 + "c"), (3, "a " * 49), (4, "a b " * 1500)]
    rows += [(5, "c " + "a b " * 900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(without_copied_passages(docs)) == brute_force(rows)


def longest(symbols, owners, i):
    best = 0
    for j in range(len(symbols)):
        if owners[j] < owners[i]:
            k = 0
            while max(i, j) + k < len(symbols) and symbols[i + k] == symbols[j + k]:
                k += 1
            best = max(best, k)
    return best


def test_matches_and_factors():
    rng = np.random.default_rng(8)
    for size, kinds in ((60, 2), (200, 3), (150, 1), (90, 50)):
        symbols = rng.integers(0, kinds, size)
        owners = np.sort(rng.integers(0, 6, size))
        at = np.flatnonzero(np.diff(owners)) + 1
        symbols[at] = kinds + np.arange(len(at))  # nothing goes on beyond the next owner
        matches = Index(symbols, size).longest_earlier(owners)
        assert matches.tolist() == [longest(symbols, owners, i) for i in range(size)]
        begins, ends = np.array([0, size // 2]), np.array([size // 2 - 1, size - 1])
        capped = np.minimum(matches, np.repeat(ends, [size // 2, size - size // 2]) - np.arange(size))
        want = []
        for i, end in zip(begins, ends):
            while i < end:
                want.append(i)
                i += max(1, capped[i])
        assert factors(np.maximum(capped, 0), begins, ends).tolist() == want


def test_windows_across_ends_of_factors():
    """The middle body's windows begin inside factors that are too short to count."""
    rng = random.Random(9)
    words = [str(i).encode() for i in rng.sample(range(10_000), 300)]
    first = [words[:60], words[30:150], words[140:260]]
    bodies = [b" ".join(w) for w in (*first, words[:260], words[5:58])]
    spans = copied(bodies, np.array([0, 1, 2, 3, 4]))
    assert [(a.tolist(), b.tolist()) for a, b in spans[3:]] == [([0], [260]), ([0], [53])]
    assert all(not len(a) for a, _ in spans[:3])


def test_the_registered_query(spark, tmp_path):
    rows = corpus(seed=10, n=30)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs.selectExpr("*", "'x' AS lang").write.parquet(f"{tmp_path}/documents.parquet")
    result = QUERIES["op12_copied_passages"](spark, str(tmp_path))
    assert result.dtypes == [("doc_id", "bigint"), ("n_words", "bigint"), ("n_removed", "bigint"),
                             ("kept_sha256", "string")]
    assert sorted(map(tuple, result.collect()), key=repr) == [w[:4] for w in brute_force(rows)]


def test_awkward_rows(awkward, empty):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    rows_twice = awkward.unionByName(awkward.withColumn("doc_id", awkward["doc_id"] + 10))
    twice = rows + [(None if i is None else i + 10, t) for i, t in rows]
    assert found(without_copied_passages(rows_twice)) == brute_force(twice)
    assert without_copied_passages(empty).count() == 0
