import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from feedlake.llm.queries import QUERIES
from feedlake.llm.spelling import checksums, near_pairs, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words_of(rows):
    counted = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if crc % 97 == 0:
                cut = crc % len(run)
                run = run[:cut] + run[cut + 1 :]
            counted[run] += 1
    return {w: n for w, n in counted.items() if len(w) >= 5 and n >= 3}


def edited(a, b):
    """Does one insertion, deletion or replacement of a code point lead from one to the other?"""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants(words):
    forms, want = {}, {}
    for w, n in words.items():
        near = [x for x in words if abs(len(x) - len(w)) < 2 and edited(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        if best is None or words[best] < 2 * n:
            best = None
        forms[w] = best
        want[w] = [best, n, len(near), words.get(best)]
    for w, row in want.items():
        root = w
        while forms[root]:
            root = forms[root]
        row.insert(1, root)
    return {w: tuple(row) for w, row in want.items()}


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.fixture
def corpus():
    rng = random.Random(5)
    stems = ["tion", "able", "ßung", "ément", "aaaa", "abab"]
    base = ["".join(rng.choices("abcé", k=rng.randint(1, 5))) + rng.choice(stems) for _ in range(150)]
    rows = []
    for doc_id in range(60):
        some = rng.choices(base, k=120)
        for k in range(0, len(some), 6):
            w, at = some[k], rng.randrange(len(some[k]))
            some[k] = rng.choice([w[:at] + w[at + 1 :], w[:at] + "Ab" [at % 2] + w[at:], w[:at] + "x" + w[at + 1 :]])
        rows.append((doc_id, rng.choice([" ", "-1", "日", "\n", "Ā"]).join(some)))
    return rows + [(70, "A×B÷cde " * 3 + "z" * 3000 + " " + "z" * 2999 + "y"), (71, None)]


def test_checksums_continue_from_what_stands_before():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = np.sort(rng.integers(0, 4000, 300))
    ends = starts + rng.integers(0, 200, 300)
    before = np.array([zlib.crc32(b"%d:" % k) for k in range(300)], np.uint32)
    want = [zlib.crc32(b"%d:" % k + data[a:b].tobytes()) for k, (a, b) in enumerate(zip(starts, ends))]
    assert checksums(data, starts, ends, before).tolist() == want


def test_equals_all_pairs(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id bigint, text string").repartition(4)
    want = variants(words_of(corpus))
    assert sum(row[0] is not None for row in want.values()) > 20
    assert any(row[1] != row[0] for row in want.values() if row[0])
    assert result(spelling_variants(docs)) == want


@pytest.mark.parametrize("most", [0, 3, 10**9])
def test_splitting_chunks_loses_no_pair(spark, most):
    """With a small alphabet, common beginnings, ends and repeats every key is shared by many."""
    rng = random.Random(6)
    words = {"".join(rng.choices("ab", k=rng.randint(5, 8))) for _ in range(250)}
    words |= {"start" + "".join(rng.choices("xyzé", k=3)) for _ in range(80)}
    words |= {"".join(rng.choices("xyz", k=3)) + "ending" for _ in range(80)}
    words |= {"a" * k for k in range(5, 40)}
    words = sorted(words)
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    found = [(r.a, r.b) for r in near_pairs(frame, most).collect()]
    want = {frozenset(p) for i, a in enumerate(words) for p in
            [(a, b) for b in words[i + 1 :] if edited(a, b)]}
    assert len(found) == len(want) and {frozenset(p) for p in found} == want


def test_the_registered_query(spark, corpus, tmp_path):
    docs = spark.createDataFrame(corpus[:30], "doc_id bigint, text string")
    docs.selectExpr("*", "'x' AS lang").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op13_spelling_variants"](spark, str(tmp_path))
    assert found.dtypes == [("word", "string"), ("form", "string"), ("root", "string"),
                            ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    assert result(found) == variants(words_of(corpus[:30]))


def test_awkward_rows(spark, awkward, empty):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    want = variants(words_of(rows))
    assert want and result(spelling_variants(awkward)) == want
    assert spelling_variants(empty).count() == 0
