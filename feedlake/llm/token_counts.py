"""Token counts of sections by offset mapping (4).

A document is encoded once and whole, so that its tokens are those a model sees. The vocabulary is a
byte-level one: a text's tokens, laid end to end, are its bytes, so each token's span follows from
the lengths of those before it. Sections are spans of the same text, and an interval join of the two
sorted lists of bounds attributes every token.

A token that crosses a section's end goes to one section by rule: "first" (that of its first byte),
"last" (that of its last byte) or "most" (the one with most of its bytes, the earlier on a tie).
Sections cover the text, so the counts of a document add up to its tokens.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from feedlake.llm.text import blocks

RULES = ("first", "last", "most")

# The end of patterns that leave a run of blanks whole but for its last one, if a word follows. Of
# such a run the encoder's search fails beyond about a million.
BLANK_RUNS = r"\s+(?!\S)|\s+"

# Runs of so many characters with the property White_Space (fixed values) are encoded as pieces.
_LONG_RUN = re.compile(
    "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{100000,}"
)


def load_encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """An encoding from a file of base64 tokens and ranks; no special tokens."""
    pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode_text(encoding: tiktoken.Encoding, text: str) -> list[int]:
    """The ids of a whole text, also where runs of blanks are longer than the encoder's search takes.

    Such a run is cut where the pattern cuts it: before its last blank, which may belong to the next
    word, or not at all at the text's end. No piece before it looks further than to the run.
    """
    ids, done = [], 0
    if encoding._pat_str.endswith(BLANK_RUNS):
        for run in _LONG_RUN.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            ids += encoding.encode_ordinary(text[done : run.start()])
            ids += encoding._encode_single_piece(text[run.start() : end].encode())
            done = end
    return ids + encoding.encode_ordinary(text[done:])


def token_lengths(encoding: tiktoken.Encoding) -> np.ndarray:
    """Bytes of every token, by id."""
    lengths = np.zeros(encoding.n_vocab, np.int64)
    for token in encoding.token_byte_values():
        lengths[encoding.encode_single_token(token)] = len(token)
    return lengths


def line_ends(body: np.ndarray) -> np.ndarray:
    """Where the lines of a text end, each with its line feed; a text without bytes has none."""
    ends = np.flatnonzero(body == 0x0A) + 1
    return ends if len(ends) and ends[-1] == len(body) else np.append(ends, len(body))


def attributed(token_ends: np.ndarray, section_ends: np.ndarray, rule: str) -> np.ndarray:
    """The section of every token. Both lists of ends are sorted and stop at the same byte."""
    token_starts = np.concatenate([token_ends[:0], [0], token_ends[:-1]])[: len(token_ends)]
    first = np.searchsorted(section_ends, token_starts, "right")
    last = np.searchsorted(section_ends, token_ends - 1, "right")
    if rule == "first":
        return first
    if rule == "last":
        return last
    chosen = first.copy()
    for at in np.flatnonzero(first != last):
        inside = section_ends[first[at] : last[at]]
        edges = np.concatenate([[token_starts[at]], inside, [token_ends[at]]])
        chosen[at] = first[at] + np.argmax(np.diff(edges))
    return chosen


def section_tokens(
    docs: DataFrame, vocabulary: str, pattern: str, rule: str = "first"
) -> DataFrame:
    """Tokens of every line of `docs(doc_id, text)`.

    Columns: `doc_id, section, start_byte, n_bytes, n_tokens, n_crossing, doc_tokens`: a row for
    each line, numbered from 0; `n_crossing` of its tokens reach over one of its bounds. A null or
    empty text is one section without tokens. Texts of any length and with any runs are encoded
    whole, if `pattern` ends like `BLANK_RUNS`; with others the encoder may fail on a million blanks
    in a row. Repeated rows are each returned. No shuffle.
    """
    if rule not in RULES:
        raise ValueError(f"a token is attributed by one of {RULES}, not by {rule}")
    names = [
        "doc_id", "section", "start_byte", "n_bytes", "n_tokens", "n_crossing", "doc_tokens",
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(vocabulary, pattern)
        lengths = token_lengths(encoding)
        for rows, data, bounds in blocks(batches, "text"):
            owner, columns = [], [[] for _ in names[1:]]
            for i in range(len(rows)):
                body = data[bounds[i] : bounds[i + 1]]
                ids = encode_text(encoding, body.tobytes().decode())
                token_ends = np.cumsum(lengths[ids]) if ids else np.empty(0, np.int64)
                ends = line_ends(body)
                starts = np.concatenate([[0], ends[:-1]])
                chosen = attributed(token_ends, ends, rule)
                crossing = attributed(token_ends, ends, "first") != attributed(
                    token_ends, ends, "last"
                )
                n = len(ends)
                owner.append(np.full(n, i))
                values = (
                    np.arange(n),
                    starts,
                    ends - starts,
                    np.bincount(chosen, minlength=n),
                    np.bincount(chosen[crossing], minlength=n),
                    np.full(n, len(ids)),
                )
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(np.concatenate(owner))),
                    *(pa.array(np.concatenate(c)) for c in columns),
                ],
                names=names,
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{name} bigint" for name in names[1:])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {counts}")
