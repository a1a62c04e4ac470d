"""Quality rules as a short-circuit cascade (7).

Each rule looks at a few measures of a text. Every task draws a sample of its rows as it goes, and
estimates on it the cost of every rule's measures and the share of texts that the rule rejects;
rules run in the order of rejections per cost, each only over the texts that no earlier rule has
rejected. The order changes the time, never the verdict, which is that no rule rejects. Nothing is
read twice for the sample, and none of it leaves the task.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StringType, StructField

from feedlake.llm.text import SPACED, Words, mixed, span_hashes, with_columns

# One in so many rows is drawn for the sample.
SAMPLE_EVERY = 16

# Symbols that are counted.
SYMBOLS = "#*$%&|<>"

_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True


class Block:
    """Rows of texts with their words; every measure is one number per row."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds
        self.words = Words(data, bounds, SPACED)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def rows(self, kept: np.ndarray) -> Block:
        """The block of the rows where `kept` is true."""
        if kept.all():
            return self
        lengths = np.diff(self.bounds)
        bounds = np.concatenate([[0], np.cumsum(lengths[kept])])
        return Block(self.data[np.repeat(kept, lengths)], bounds)

    def per_row(self, marks: np.ndarray) -> np.ndarray:
        """How many true marks, one per byte, each row has."""
        return np.diff(np.searchsorted(np.flatnonzero(marks), self.bounds))


def n_words(block: Block) -> np.ndarray:
    return block.words.counts


def word_chars(block: Block) -> np.ndarray:
    """Code points in words: their bytes without continuation bytes."""
    return block.per_row(SPACED[block.data] & ((block.data & 0xC0) != 0x80))


def n_symbols(block: Block) -> np.ndarray:
    return block.per_row(_IS_SYMBOL[block.data])


def _repeats(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: whether its row has an earlier equal one, and whether it has any other."""
    keys = mixed(hashes + mixed(rows.astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later, any_other = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
    later[order[1:]] = same
    any_other[order[1:]] |= same
    any_other[order[:-1]] |= same
    return later, any_other


def _lines(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and hashes of the lines that hold a word."""
    breaks = np.flatnonzero(block.data == 0x0A)
    starts = np.concatenate([block.bounds[:-1], breaks + 1])
    ends = np.concatenate([breaks, block.bounds[1:]])
    starts.sort()
    ends.sort()
    words = block.words.starts
    holds = np.searchsorted(words, ends) > np.searchsorted(words, starts)
    starts, ends = starts[holds], ends[holds]
    rows = np.searchsorted(block.bounds, starts, "right") - 1
    return rows, span_hashes(block.data, starts, ends)


def n_lines(block: Block) -> np.ndarray:
    return np.bincount(_lines(block)[0], minlength=len(block))


def n_dup_lines(block: Block) -> np.ndarray:
    rows, hashes = _lines(block)
    return np.bincount(rows[_repeats(rows, hashes)[0]], minlength=len(block))


def n_repeat_words(block: Block) -> np.ndarray:
    """Words that lie in a window of three that the text holds at least twice."""
    words = block.words
    at, grams = words.grams(words.hashes(), 3)
    hit = at[_repeats(words.rows[at], grams)[1]]
    covered = np.zeros(len(words.starts), bool)
    for k in range(3):
        covered[hit + k] = True
    return np.bincount(words.rows[covered], minlength=len(block))


MEASURES = {
    "n_words": n_words,
    "word_chars": word_chars,
    "n_symbols": n_symbols,
    "n_lines": n_lines,
    "n_dup_lines": n_dup_lines,
    "n_repeat_words": n_repeat_words,
}


@dataclass(frozen=True)
class Rule:
    """`rejects` gets the named measures, one array each, and says which rows it rejects."""

    name: str
    measures: tuple[str, ...]
    rejects: Callable[..., np.ndarray]


def too_short(least: int = 50) -> Rule:
    return Rule("too_short", ("n_words",), lambda words: words < least)


def repetitive(most_percent: int = 50) -> Rule:
    return Rule(
        "repetitive",
        ("n_repeat_words", "n_words"),
        lambda repeated, words: 100 * repeated > most_percent * words,
    )


def odd_words(least: float = 2, most: float = 16) -> Rule:
    """Mean word length outside of a range."""
    return Rule(
        "odd_words",
        ("word_chars", "n_words"),
        lambda chars, words: (chars < least * words) | (chars > most * words),
    )


def symbols(most_percent: int = 10) -> Rule:
    return Rule(
        "symbols",
        ("n_symbols", "n_words"),
        lambda found, words: 100 * found > most_percent * words,
    )


def repeated_lines(most_percent: int = 60) -> Rule:
    return Rule(
        "repeated_lines",
        ("n_dup_lines", "n_lines"),
        lambda again, lines: 100 * again > most_percent * lines,
    )


BASE = (too_short(), repetitive())
RULES = (*BASE, odd_words(), symbols(), repeated_lines())


class Estimates:
    """What the rules cost and reject, on a sample of the rows that a task has come to."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.seconds, self.rejected = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0)
        self.rows = 0

    def learn(self, block: Block) -> None:
        """Run every rule over the rows of a block that are drawn."""
        drawn = (np.arange(len(block)) + self.rows) % SAMPLE_EVERY == 0
        self.rows += len(block)
        if not drawn.any():
            return
        sample = block.rows(drawn)
        for rule in self.rules:
            began = time.perf_counter()
            rejected = rule.rejects(*(MEASURES[m](sample) for m in rule.measures))
            self.seconds[rule] += time.perf_counter() - began
            self.rejected[rule] += int(rejected.sum())

    def order(self) -> tuple[Rule, ...]:
        """The rules by rejections per second; before any row is drawn, as they are given."""
        gain = {rule: self.rejected[rule] / (self.seconds[rule] or 1) for rule in self.rules}
        return tuple(sorted(self.rules, key=gain.get, reverse=True))


def judge(block: Block, order: tuple[Rule, ...], known: dict[str, np.ndarray]) -> np.ndarray:
    """The position in `order` of the first rule that rejects each row, or -1.

    `known` holds measures that were taken of every row already.
    """
    verdict, live, left = np.full(len(block), -1), np.arange(len(block)), block
    for position, rule in enumerate(order):
        if not len(live):
            break
        taken = (known[m][live] if m in known else MEASURES[m](left) for m in rule.measures)
        rejected = rule.rejects(*taken)
        verdict[live[rejected]] = position
        if rejected.any():
            live, left = live[~rejected], left.rows(~rejected)
    return verdict


def first_failed(
    block: Block, rules: tuple[Rule, ...], order: tuple[Rule, ...], known: dict[str, np.ndarray]
) -> np.ndarray:
    """The position in `rules` of the first rule that rejects each row, or -1, judged in `order`.

    Rows that the cascade rejects are also tried by earlier `rules` that it has not come to.
    """
    verdict = judge(block, order, known)
    found = np.array([*map(rules.index, order), -1])[verdict]
    for k, rule in enumerate(rules):
        untried = (verdict >= 0) & (verdict < order.index(rule)) & (found > k)
        if untried.any():
            left = block.rows(untried)
            taken = (known[m][untried] if m in known else MEASURES[m](left) for m in rule.measures)
            found[np.flatnonzero(untried)[rule.rejects(*taken)]] = k
    return found


def passing(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, verdict: str = "kept"
) -> DataFrame:
    """`docs` with a boolean column `verdict`: true where no rule rejects the row.

    A null or empty text has no words. All columns of `docs` stay; one that is called as the verdict
    is replaced. Repeated rows are judged each for itself. No shuffle.
    """
    estimates = Estimates(rules)

    def compute(data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
        block = Block(data, bounds)
        estimates.learn(block)
        return [pa.array(judge(block, estimates.order(), {}) < 0)]

    return with_columns(docs, [StructField(verdict, BooleanType())], compute)


def quality_cascade(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    measures: tuple[str, ...] = (),
) -> DataFrame:
    """`docs` with `failed_rule` (null: kept) and the asked `measures` of every row.

    The verdict is that of `passing`. `failed_rule` names the first of `rules` that rejects a row,
    for which rejected rows are also tried by rules that the cascade need not have come to. Measures
    that are asked for are taken of every row. Null, empty and repeated rows and other columns are
    treated as there; columns that are called as an output column are replaced.
    """
    own = [StructField("failed_rule", StringType()), *(StructField(m, LongType()) for m in measures)]
    names = np.array([r.name for r in rules] + [None], dtype=object)
    estimates = Estimates(rules)

    def compute(data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
        block = Block(data, bounds)
        estimates.learn(block)
        known = {m: MEASURES[m](block) for m in measures}
        failed = names[first_failed(block, rules, estimates.order(), known)]
        return [pa.array(failed, pa.string()), *(pa.array(known[m], pa.int64()) for m in measures)]

    return with_columns(docs, own, compute)
