"""Token ids of whole texts, with each distinct word encoded once."""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

# Spark already runs a task on every core.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Characters up to here are plain Latin text, for which a word's ids do not depend on the library's
# handling of case and white space in context.
_LATIN = 0x24F

# Distinct words that one worker remembers, some 120 bytes each; beyond it, it starts afresh.
REMEMBERED = 1 << 18


def _class(kinds: str) -> str:
    chars = (chr(c) for c in range(0x21, _LATIN + 1))
    return "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] in kinds)


_LETTER, _NUMBER = _class("L"), _class("N")
_WORD = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}]+"
)
_UNUSUAL = re.compile(f"[^\\t\\n\\r -~\xa1-{chr(_LATIN)}‐-‧]|<\\|")


class WordEncoder:
    """Encodes as `tokenizer.encode(text, add_special_tokens=False)` does, for the word-level BPE.

    That tokenizer lower-cases, drops white space, cuts text by one pattern, and encodes each part
    alone. So the distinct parts of a text are encoded together, separated by spaces; a part's ids
    end with the one that carries the end-of-word mark. Texts with characters for which this is not
    certain, and those in which a special token's name may occur, are encoded whole.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        # the same vocabulary for words that are cut and lower-cased already
        self.alone = Tokenizer(tokenizer.model)
        self.alone.pre_tokenizer = Sequence(
            [WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        names = tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(0, np.uint32)
        self.first = np.zeros(1, np.int64)

    def _learn(self, new: list[str]) -> None:
        chunks = [" ".join(new[i : i + 2000]) for i in range(0, len(new), 2000)]
        encoded = self.alone.encode_batch_fast(chunks, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in encoded])
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(new):  # a word spells the mark itself
            encoded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in encoded])
            ends = np.cumsum([len(e.ids) for e in encoded])
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.first = np.concatenate([self.first, ends + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])

    def _places(self, words: list[str]) -> np.ndarray:
        """The number under which each word is known."""
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            self._learn(list(dict.fromkeys(words[i] for i in missing)))
            at[missing] = [self.known[words[i]] for i in missing]
        return at

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of every row of a block."""
        if len(self.known) > REMEMBERED:
            self._forget()
        texts = [data[a:b].tobytes().decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        usual = [
            not _UNUSUAL.search(text) and unicodedata.is_normalized("NFC", text) for text in texts
        ]
        words = [
            _WORD.findall(text.lower()) if plain else []
            for text, plain in zip(texts, usual, strict=True)
        ]
        places = self._places(list(chain.from_iterable(words)))
        ends = np.cumsum([len(part) for part in words])
        for text, plain, part, end in zip(texts, usual, words, ends, strict=True):
            if not plain:
                encoded = self.tokenizer.encode(text, add_special_tokens=False)
                yield np.array(encoded.ids, np.uint32)
                continue
            at = places[end - len(part) : end]
            first, sizes = self.first[at], self.first[at + 1] - self.first[at]
            shift = np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
            yield self.ids[shift + np.arange(len(shift))]


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file; what it has learned serves its next tasks too."""
    return WordEncoder(Tokenizer.from_file(path))
