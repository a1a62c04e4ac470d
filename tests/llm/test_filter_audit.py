import itertools
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from feedlake.llm.filter_audit import filter_audit
from feedlake.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
REPORT = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failing(rows):
    """For each row (doc_id, text, lang) the letters of the filters that it fails."""
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
            fails.add("C")
        if re.search(r"[#$%&*|]", text):
            fails.add("D")
        ids = [other for other, t, _ in rows if (t or "") == text and other is not None]
        if ids and (doc_id is None or min(ids) < doc_id):
            fails.add("E")
        out.append(fails)
    return out


def simulated(rows, labels):
    """Applies every order of filters, one after the other, to the rows of each part."""
    fails = failing(rows)
    want = {}
    for part in {lang or "" for _, _, lang in rows}:
        own = [(r[0], f) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
        shapley = defaultdict(int)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(own)
            for step, name in enumerate(order, 1):
                gone = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                good, toxic = (
                    sum(labels.get(i, (0, 0))[k] == 1 for i, _ in gone) for k in (0, 1)
                )
                every = sum(name in f for _, f in own)
                shapley[name] += len(gone)
                want[part, order, step] = [
                    len(left), len(gone), every - len(gone),
                    sum(f == {name} for _, f in own), good, toxic,
                ]
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, name in enumerate(order, 1):
                want[part, order, step].append(shapley[name])
    return want


def result(df):
    return {(r.part, r.filter_order, r.step): [r[c] for c in REPORT] for r in df.collect()}


@pytest.fixture
def corpus():
    rng = random.Random(3)
    words = ["aa", "bé", "Cc", "DDDD", "日本", "x#", "1|2", "e f"] + [f"w{i}" for i in range(150)]
    texts = [
        rng.choice([" ", "\n", " \t"]).join(rng.choices(words[rng.randint(0, 20) :], k=k))
        for k in [0, 1, 150, 199, 200, 201, 250, 400] * 12
    ]
    texts += ["a " * 200, "a b " * 150, "A" * 3 + "b" * 97, "A" * 4 + "b" * 97]
    rows = [(i, t, rng.choice(["en", "de", None])) for i, t in enumerate(texts)]
    rows += [(200 + i, texts[i % 30], rng.choice(["en", "fr", ""])) for i in range(60)]
    return rows + [(300, None, "en"), (301, "", "xx"), (301, "", "xx"), (None, texts[3], "en")]


def test_equals_filters_applied_one_after_the_other(spark, corpus):
    rng = random.Random(4)
    labels = [(i, rng.choice([0, 1, None]), rng.randint(0, 1)) for i in range(0, 310, 2)]
    docs = spark.createDataFrame(corpus, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    want = simulated(corpus, {i: (q, t) for i, q, t in labels})
    found = filter_audit(docs.repartition(5), marks)
    assert result(found) == want and found.count() == len(want)
    # a label that is given twice counts once
    assert result(filter_audit(docs, marks.unionAll(marks))) == want


def test_the_registered_query(spark, corpus, tmp_path):
    docs = spark.createDataFrame(corpus, "doc_id bigint, text string, lang string")
    docs.withColumn("source", F.lit("s")).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, i % 2, i % 3 % 2) for i in range(0, 310, 2)]
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    found = QUERIES["op11_filter_audit"](spark, str(tmp_path))
    assert found.columns == ["part", "filter_order", "step", *REPORT]
    assert result(found) == simulated(corpus, {i: (q, t) for i, q, t in labels})


def test_awkward_rows(spark, awkward, empty):
    marks = spark.createDataFrame([(1, 1, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    rows = [(r.doc_id, r.text, r.lang) for r in awkward.collect()]
    assert result(filter_audit(awkward, marks)) == simulated(rows, {1: (1, 1)})
    by_source = filter_audit(awkward, marks, part="source")
    assert {r.part for r in by_source.collect()} == {""}
    assert filter_audit(empty, marks).count() == 0
    assert filter_audit(awkward, marks.limit(0)).where("good_lost + toxic_lost > 0").count() == 0
