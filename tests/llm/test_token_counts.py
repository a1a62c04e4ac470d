import bisect
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedlake.llm import token_counts
from feedlake.llm.token_counts import (
    RULES,
    attributed,
    encode_text,
    line_ends,
    load_encoding,
    section_tokens,
)

ENCODINGS = []
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_counts_are_those_of_another_librarys_offsets(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    found = {}
    for r in section_tokens(rows, PATH, public_tokenizers.PATTERN).collect():
        found.setdefault(r.doc_id, []).append((r.section, r.n_tokens))
    for r in rows.collect():
        lines = r.text.splitlines(keepends=True)
        bounds = [0, *np.cumsum([len(x) for x in lines]).tolist()]
        counts = [0] * len(lines)
        for start, _ in other.encode(r.text, add_special_tokens=False).offsets:
            counts[bisect.bisect_right(bounds, start) - 1] += 1
        assert [n for _, n in sorted(found[r.doc_id])] == counts


@settings(deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=20), st.data(), st.sampled_from(RULES))
def test_every_token_goes_to_one_section_by_the_rule(lengths, data, rule):
    ends = np.cumsum(lengths)
    inner = data.draw(st.sets(st.integers(1, int(ends[-1])), max_size=6)) - {int(ends[-1])}
    sections = np.array([*sorted(inner), ends[-1]])
    chosen = attributed(ends, sections, rule)
    for token, (start, end) in enumerate(zip(ends - lengths, ends)):
        owners = [bisect.bisect_right(sections.tolist(), at) for at in range(start, end)]
        most = max(sorted(set(owners)), key=owners.count)
        assert chosen[token] == {"first": owners[0], "last": owners[-1], "most": most}[rule]


@given(st.text("ab\n", max_size=12))
def test_lines_cover_the_text(text):
    ends = line_ends(np.frombuffer(text.encode(), np.uint8))
    lines = text.splitlines(keepends=True) or [""]
    assert ends.tolist() == np.cumsum([len(x) for x in lines]).tolist()


def test_the_rules_differ_on_a_crossing_token(spark):
    docs = spark.createDataFrame([(1, "a\n\n\n\nb")], "doc_id int, text string")
    encoding = load_encoding(PATH, public_tokenizers.PATTERN)
    tokens = len(encoding.encode_ordinary("a\n\n\n\nb"))
    counts = set()
    for rule in RULES:
        rows = section_tokens(docs, PATH, public_tokenizers.PATTERN, rule).collect()
        assert sum(r.n_tokens for r in rows) == tokens == rows[0].doc_tokens
        assert sum(r.n_crossing for r in rows) > 0
        counts.add(tuple(r.n_tokens for r in sorted(rows, key=lambda r: r.section)))
    assert len(counts) > 1
    with pytest.raises(ValueError):
        section_tokens(docs, PATH, public_tokenizers.PATTERN, "any")


def test_runs_of_any_length_are_encoded(spark):
    million = 2_000_000
    texts = [c * million for c in " \na1#"] + ["a" + " " * million + "b\n" + "\t" * million + "c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {}
    for r in section_tokens(docs, PATH, public_tokenizers.PATTERN).where("section = 0").collect():
        found[r.doc_id] = r.doc_tokens
    encoding = load_encoding(PATH, public_tokenizers.PATTERN)
    tokens = {i: encode_text(encoding, t) for i, t in enumerate(texts)}
    assert found == {i: len(ids) for i, ids in tokens.items()}
    assert all(encoding.decode(tokens[i]) == t for i, t in enumerate(texts))


@settings(deadline=None, max_examples=300)
@given(st.lists(st.sampled_from([*" \n\xa0\u3000a#\x1cé", "\t\t", "  ", "B1", "'s"]), max_size=14))
def test_cut_runs_give_the_encoders_ids(parts):
    text = "".join(parts)
    encoding = load_encoding(PATH, public_tokenizers.PATTERN) if not ENCODINGS else ENCODINGS[0]
    ENCODINGS[:] = [encoding]
    short = re.compile(token_counts._LONG_RUN.pattern.replace("100000", "2"))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(token_counts, "_LONG_RUN", short)
        assert encode_text(encoding, text) == encoding.encode_ordinary(text)


def test_awkward_rows(awkward, empty):
    rows = section_tokens(awkward, PATH, public_tokenizers.PATTERN).collect()
    assert sorted((r.section, r.n_tokens, r.n_bytes) for r in rows if r.doc_id in (1, 2)) == [
        (0, 0, 0), (0, 0, 0)
    ]
    assert sum(r.doc_id == 4 for r in rows) == 2
    assert section_tokens(empty, PATH, public_tokenizers.PATTERN).count() == 0
