import random
import re
from collections import Counter

import numpy as np

from feedlake.llm.quality import (
    MEASURES,
    RULES,
    SAMPLE_EVERY,
    SYMBOLS,
    Block,
    Estimates,
    first_failed,
    judge,
    passing,
    quality_cascade,
)

LONG = " ".join(f"word{i}" for i in range(200))
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    words = WORD.findall(text)
    seen, lines, again = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            again += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {
        i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)
    }
    symbols = sum(c in SYMBOLS for c in text)
    return [len(words), sum(map(len, words)), symbols, lines, again, len(covered)]


def block(texts):
    raw = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in raw], dtype=np.int64)])
    return Block(np.frombuffer(b"".join(raw), np.uint8), bounds)


def test_measures_are_those_of_plain_python():
    rng = random.Random(1)
    texts = ["", " ", "\n", "a", "a\na\n a", "é#日本 | x"]
    alphabet = ["a", "b ", "cé", "\n", " ", "\t", "#", "a b c ", "\x0b"]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(300)]
    found = np.stack([m(block(texts)) for m in MEASURES.values()], axis=1)
    assert found.tolist() == [measured(t) for t in texts]


def test_the_order_of_rules_changes_no_verdict():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices([*words, "#$", "\nxx yy\n"], k=rng.randint(0, 150)))
             for _ in range(200)] + ["# $ " * 80, "w" * 2000, "ab cd\n" * 60]
    verdicts = {tuple(judge(block(texts), order, {}) < 0) for order in (RULES, RULES[::-1])}
    assert len(verdicts) == 1 and 0 < sum(next(iter(verdicts))) < 203


def test_the_failed_rule_is_the_first_given_whatever_the_order(spark):
    texts = ["# $ " * 10, "# $ " * 80, "w" * 2000, "ab cd\n" * 60, LONG, ""]
    want = {"# $ " * 10: "too_short", "# $ " * 80: "repetitive", "w" * 2000: "too_short",
            "ab cd\n" * 60: "repetitive", LONG: None, "": "too_short"}
    names = [r.name for r in RULES] + [None]
    for order in (RULES, RULES[::-1]):
        found = first_failed(block(texts), RULES, order, {})
        assert {t: names[k] for t, k in zip(texts, found)} == want
    docs = spark.createDataFrame([(t,) for t in texts * 20], "text string")
    assert {r.text: r.failed_rule for r in quality_cascade(docs).collect()} == want
    assert {r.text: r.kept for r in passing(docs).collect()} == {t: want[t] is None for t in want}


def test_the_sample_is_drawn_over_all_rows_of_a_task():
    """Only later rows are bad in a way, which the order of the rules follows."""
    estimates, short = Estimates(RULES), " ".join(f"word{i}" for i in range(60))
    assert estimates.order() == RULES
    estimates.learn(block([short] * 300))
    estimates.learn(block(["# $ " * 80] * 300))
    assert estimates.rows == 600 and max(estimates.rejected.values()) <= 600 / SAMPLE_EVERY
    assert estimates.order()[0].name != "too_short"
    drawn = Estimates(RULES)
    for k in range(SAMPLE_EVERY * 2):  # blocks of one row each
        drawn.learn(block(["x"]))
    assert drawn.rejected[RULES[0]] == 2


def test_awkward_rows(awkward, empty):
    rows = quality_cascade(awkward, measures=("n_words",))
    assert rows.columns.count("failed_rule") == 1 and "a.b" in rows.columns
    kept = {r.doc_id: r.failed_rule is None for r in rows.collect()}
    assert kept == {1: False, 2: False, 3: False, 4: False, 5: False, None: False, 6: True,
                    7: False}
    assert rows.count() == 9 and quality_cascade(empty).count() == 0
