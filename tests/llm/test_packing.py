import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedlake.llm import packing
from feedlake.llm.packing import RoomTree, best_fit, pack, pieces, powers
from feedlake.llm.tokens import word_encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids(text):
    found = TOKENIZER.encode(text or "", add_special_tokens=False).ids
    return np.array([*found, 2], "<u4")


@given(st.lists(st.integers(1, 4095), max_size=200))
def test_best_fit_decreasing_is_that_of_a_plain_search(lengths):
    lengths = np.array(lengths, np.int64)
    number, offset = best_fit(lengths, 4096)
    room = []
    for i in np.argsort(-lengths, kind="stable"):
        fits = [(r, k) for k, r in enumerate(room) if r >= lengths[i]]
        if not fits:
            room.append(4096)
            fits = [(4096, len(room) - 1)]
        tightest = min(r for r, _ in fits)
        assert 4096 - offset[i] == tightest == room[number[i]]
        room[number[i]] -= lengths[i]


def test_the_tree_finds_the_tightest_room():
    tree = RoomTree(10)
    for room, window in ((3, 0), (7, 1), (7, 2)):
        tree.add(room, window)
    assert tree.take(4)[0] == 7 and tree.take(3) == (3, 0)
    assert tree.take(8) is None and tree.take(1)[0] == 7 and tree.take(1) is None


@given(st.integers(1, 5000))
def test_powers_cover_a_length(length):
    cuts = powers(length)
    assert [a for a, _ in cuts] == [0, *(b for _, b in cuts[:-1])] and cuts[-1][1] == length
    assert all((b - a) & (b - a - 1) == 0 for a, b in cuts)


@settings(deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_words_encoded_alone_give_the_ids_of_the_text(text):
    raw = text.encode()
    (found,) = word_encoder(PATH).encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert found.tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(deadline=None, max_examples=300)
@given(st.text("aZé' \n\t!09<|/w>İßŒœʼn…", max_size=30))
def test_words_of_awkward_characters(text):
    raw = text.encode()
    (found,) = word_encoder(PATH).encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert found.tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("shard", [50_000, 2])
def test_every_token_lies_in_one_place(spark, awkward, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD_PIECES", shard)
    rows = pack(pieces(awkward, PATH)).collect()
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in windows.values():
        held.sort()
        assert held[0][0] == 0 and sum(n for _, n in held) <= 4096
        assert all(a + n == b for (a, n), (b, _) in zip(held, held[1:]))
    texts = {}
    for r in awkward.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append(ids(r.text))
    for doc_id, bodies in texts.items():
        own = sorted((r.start, r.length, r.crc32) for r in rows if r.doc_id == doc_id)
        assert sum(n for _, n, _ in own) == sum(len(b) for b in bodies)
        for start, length, crc in own:
            assert crc in {zlib.crc32(b[start : start + length].tobytes()) for b in bodies}


def test_little_padding(spark):
    rows = [(i, "word " * (i * 37 % 3000)) for i in range(400)]
    packed = pack(pieces(spark.createDataFrame(rows, "doc_id bigint, text string"), PATH))
    fill = packed.groupBy("sequence_id").sum("length").collect()
    padding = sum(4096 - f[1] for f in fill if f[1] & (f[1] - 1))
    assert padding < 0.03 * 4096 * len(fill)


def test_nothing_packs_to_nothing(empty):
    assert pack(pieces(empty, PATH)).count() == 0
