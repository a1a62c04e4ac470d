import random
import re

import pytest

from feedlake.llm.decontaminate import benchmark_hits, without_benchmark

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def expected(docs, items):
    windows = {}
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        size = min(10, len(words))
        for at in range(len(words) - size + 1) if size else ():
            windows.setdefault(tuple(words[at : at + size]), set()).add(str(item))
    result = []
    for doc, text in docs:
        words, hit, held = WORD.findall((text or "").translate(LOWER)), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(words) - size + 1):
                found = windows.get(tuple(words[at : at + size]))
                if found:
                    hit.update(range(at, at + size))
                    held |= found
        result.append((doc, len(words), len(hit), sorted(held)))
    return sorted(result, key=str)


def found(spark, docs, items):
    hits = benchmark_hits(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    rows = [(r.doc_id, r.n_words, r.n_hit, r.items) for r in hits.collect()]
    return sorted(rows, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_hits_are_those_of_every_window(spark, seed):
    rng = random.Random(seed)

    def text(most):
        return " ".join(rng.choice(["A", "b", "c-d", "é"]) for _ in range(rng.randint(0, most)))

    items = [(i, text(25)) for i in range(12)] + [(3, "b B b"), (20, "x"), (21, None), (22, "...")]
    docs = [(i, text(120)) for i in range(60)] + [(5, None), (6, ""), (7, "X"), (7, "X")]
    docs += [(100 + i, f"{text(20)} {items[i][1]} {text(20)}") for i in range(12)]
    assert found(spark, docs, items) == expected(docs, items)


def test_a_hit_needs_the_window_whole_and_in_one_document(spark):
    item = " ".join(f"w{i}" for i in range(30))
    words = item.split()
    docs = [
        (1, " ".join(words[:9])), (2, " ".join(words[9:18])), (3, " ".join(words[4:14])),
        (4, item.upper() + "!"), (5, " ".join(words[:9] + ["x"] + words[9:18])),
    ]
    counts = [(d, n) for d, _, n, _ in found(spark, docs, [(1, item)])]
    assert counts == [(1, 0), (2, 0), (3, 10), (4, 30), (5, 0)]


def test_awkward_rows(spark, awkward, empty):
    items = spark.createDataFrame([(9, "TWO three"), (None, "it's")], "item_id int, text string")
    rows = benchmark_hits(awkward, items).collect()
    assert sum(r.n_hit > 0 for r in rows) == 5 and len(rows) == 9
    kept = without_benchmark(awkward, items)
    assert kept.columns == awkward.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "6"]
    assert benchmark_hits(empty, items).count() == 0
    nothing = benchmark_hits(awkward, items.limit(0))
    assert nothing.where("n_hit = 0 and size(items) = 0").count() == 9
