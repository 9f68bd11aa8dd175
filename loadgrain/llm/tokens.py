"""Token ids of whole texts with a tokenizer of the tokenizers library.

A tokenizer is asked once for each distinct word of a batch: its pre-tokenizer never joins what blanks
separate, nor a full stop or comma with the letter before it, so the ids of a text are those of its words in a
row. Words are asked for in groups; those of letters alone are told apart by the tokens that end a word.
"""

from __future__ import annotations

import itertools
import os

import numpy as np
import pyarrow as pa

from loadgrain.llm.common import text_bytes

# blanks at which a text may be cut; all others stay inside a word and reach the tokenizer
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 13, 32]] = True
STOP = np.zeros(256, bool)
STOP[[44, 46]] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# words remembered by a worker between batches
MAX_WORDS = 250_000
GROUP = 50

_loaded: dict[str, WordEncoder] = {}


def read_tokenizer(path: str) -> str:
    """The definition as text, to be sent to the executors: a few megabytes, as large as the vocabulary."""
    with open(path, encoding="utf-8") as f:
        return f.read()


class WordEncoder:
    """For tokenizers that lower-case, split at blanks and mark the last token of a word with ``</w>``."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.first = self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids begin."""
        data, offsets = text_bytes(texts)
        nothing = np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        if not len(data):
            return nothing
        if b"<|" not in data.tobytes():  # else it may hold a special token, which is told by its case
            plain = np.append(data[1:] < 128, True)  # letters before a combining mark are left to the tokenizer
            data = np.where(plain, LOWER[data], data)
        solid = ~BLANK[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        edge[1:-1] |= (STOP[data[1:]] & LETTER[data[:-1]]) | ~solid[:-1]
        begins = np.flatnonzero(solid & edge[:-1])
        if not len(begins):
            return nothing
        edge[1:-1] |= ~solid[1:]
        ends = np.flatnonzero(solid & edge[1:]) + 1
        places = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(
            len(begins), pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data[solid]))
        ).dictionary_encode()
        which = self._known(words.dictionary.to_pylist())[words.indices.to_numpy()]
        count = self.size[which]
        done = np.concatenate([[0], np.cumsum(count)])
        out = self.flat[np.repeat(self.first[which] - done[:-1], count) + np.arange(done[-1])]
        return out, done[np.searchsorted(begins, offsets)]

    def _known(self, words: list[str]) -> np.ndarray:
        """Where each word stands among those remembered."""
        if len(self.place) > MAX_WORDS:
            self._forget()
        place = self.place
        new = [w for w in words if w not in place]
        whole = [w for w in new if w.isalpha()]
        other = [w for w in new if not w.isalpha()]
        flat, size = self._letters(whole)
        ids = [list(found) for found in self._ask(other)]
        flat = np.concatenate([self.flat, flat, np.fromiter(itertools.chain.from_iterable(ids), np.int64)])
        self.size = np.concatenate([self.size, size, np.fromiter(map(len, ids), np.int64)])
        self.flat, self.first = flat, np.cumsum(self.size) - self.size
        place.update(zip(whole + other, range(len(place), len(place) + len(new)), strict=True))
        return np.fromiter(map(place.__getitem__, words), np.int64, len(words))

    def _ask(self, texts: list[str]) -> list[list[int]]:
        out = []
        for at in range(0, len(texts), 5_000):
            out += [found.ids for found in self.tokenizer.encode_batch_fast(texts[at : at + 5_000], add_special_tokens=False)]
        return out

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of letters in a row, and how many each has."""
        groups = [" ".join(words[at : at + GROUP]) for at in range(0, len(words), GROUP)]
        flat = np.fromiter(itertools.chain.from_iterable(self._ask(groups)), np.int64)
        ends = np.flatnonzero(self.last[flat])
        if len(ends) != len(words) or (len(ends) and ends[-1] != len(flat) - 1):
            ids = self._ask(words)
            return np.fromiter(itertools.chain.from_iterable(ids), np.int64), np.fromiter(map(len, ids), np.int64)
        return flat, np.diff(ends, prepend=-1)


def encoder(definition: str) -> WordEncoder:
    """One encoder for each worker process and tokenizer."""
    if definition not in _loaded:
        _loaded.clear()
        _loaded[definition] = WordEncoder(definition)
    return _loaded[definition]


def with_end(ids: np.ndarray, starts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text's own."""
    return np.insert(ids, starts[1:], end_id), starts + np.arange(len(starts))
