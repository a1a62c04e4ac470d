import random

import numpy as np
import pytest

from feedlake.llm.components import components
from feedlake.llm.near_duplicates import near_duplicates, without_near_duplicates

SCHEMA = "doc_id bigint, text string"


def shingles(text):
    words = (text or "").lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def expected(docs, percent):
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                label[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(docs))


def group(rng, first, size, length, changes):
    """Copies of one text, each with some words changed."""
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    for i in range(size):
        words = list(base)
        for at in rng.sample(range(length), rng.randint(0, changes)):
            words[at] = f"x{rng.randrange(10**6)}"
        yield first + i, " ".join(words)


@pytest.mark.parametrize("percent", [80, 85])
def test_components_are_those_of_all_pairs(spark, percent):
    rng = random.Random(percent)
    docs = [*group(rng, 0, 150, 150, 8), *group(rng, 200, 60, 12, 2), *group(rng, 300, 40, 6, 1)]
    docs += [(400 + i, f"a b c {i % 3}") for i in range(9)]
    docs += [(500 + i, "one and the same text of quite some words") for i in range(50)]
    docs += [(600, None), (601, ""), (602, " \n")]
    rng.shuffle(docs)
    rows = near_duplicates(spark.createDataFrame(docs, SCHEMA).repartition(5), percent).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == expected(docs, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    edges += [(200 + i, 200 + (i + 1) % 7) for i in range(7)] + [(300, 300), (41, 40)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.id: r.label for r in components(frame).collect()}
    assert found == (
        dict.fromkeys(range(42), 0)
        | dict.fromkeys(range(100, 130), 100)
        | dict.fromkeys(range(200, 207), 200)
    )


def test_awkward_rows(awkward, empty):
    rows = near_duplicates(awkward).collect()
    assert len(rows) == 9
    assert {r.component_id for r in rows if r.n_shingles == 1 and r.doc_id != 7} == {4}
    assert all(r.kept for r in rows if r.n_shingles == 0)
    kept = without_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 7]
    assert near_duplicates(empty).count() == 0 and without_near_duplicates(empty).count() == 0


def test_rows_without_any_id(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, None)], SCHEMA)
    rows = near_duplicates(docs).collect()
    assert all(r.kept and r.component_id is None for r in rows)
    assert without_near_duplicates(docs).count() == 2


def test_sets_survive_the_bounds_of_a_block():
    from feedlake.llm.near_duplicates import minima, shingle_sets

    texts = [b"a b c d e f a b c d e", b"", b"x", b"a b c d e f"]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    grams, first = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), bounds)
    assert np.diff(first).tolist() == [6, 0, 1, 2]
    assert minima(grams, first).shape[0] == 3
