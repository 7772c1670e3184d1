"""Token ids of whole texts by the tokenizers library, encoded once per distinct word.

The vocabulary's pieces never span white space and its normaliser treats each
word alone, so a text's ids are its words' ids in order.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from batchgate.llm.common import give_back

END_ID = 1
# Words remembered by a worker, none longer than this; beyond the number the older half is forgotten.
REMEMBERED = 400_000
LONGEST = 64
# ASCII signs at a word's end (but apostrophes) are a piece of their own after a Latin letter or digit.
_ENDED = "([a-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff])([!-&(-/:-@\\[-`{-~]+)([\t-\r ]|\\z)"
# Latin letters alone: such a word is one piece, so its last token has the suffix of word ends.
_LETTERS = "\\A[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+\\z"
WORD_END = "</w>"
# Words that are encoded as one string, and at a time; the library holds some 150 bytes a token.
JOINED = 200
LEARNED = 8_000
# First bytes of the marks that a letter is composed with (U+0300 to U+036F).
_MARKS = re.compile(b"[\xcc\xcd]")


def _prepared(text: bytes) -> bytes:
    """The text with its words as they are looked up.

    ASCII is lowered anyway, but names of special tokens are matched before that, and a
    lower-case letter may be composed with a mark that its capital has no form with.
    """
    if b"<|" in text:
        return text
    if _MARKS.search(text) is None:
        return text.lower()
    return b" ".join([w.lower() if _MARKS.search(w) is None else w for w in text.split()])


class WordEncoder:
    """Encodes runs of UTF-8 texts; remembers the ids of a bounded number of words."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.remembered = remembered
        entries = self.tokenizer.get_vocab()
        self.last = np.zeros(max(entries.values()) + 1, bool)
        self.last[[i for e, i in entries.items() if e.endswith(WORD_END)]] = True
        # Word i has ids[starts[i] : starts[i] + lengths[i]]; arrays have room to grow.
        self.index: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.used = np.zeros(4096, np.uint32), 0

    def _add(self, words: list[str], lengths: np.ndarray, ids: np.ndarray) -> None:
        n, k = len(self.index), len(words)
        if n + k > len(self.starts):
            self.starts = np.resize(self.starts, 2 * (n + k))
            self.lengths = np.resize(self.lengths, 2 * (n + k))
        if self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (self.used + len(ids)))
        self.starts[n : n + k] = self.used + np.cumsum(lengths) - lengths
        self.lengths[n : n + k] = lengths
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.index.update(zip(words, range(n, n + k), strict=True))

    def _forget(self) -> None:
        keep = list(self.index.items())[len(self.index) // 2 :]
        at = np.fromiter((i for _, i in keep), np.int64, len(keep))
        ids, lengths = self._gather(at), self.lengths[at]
        self.index, self.used = {}, 0
        self._add([w for w, _ in keep], lengths, ids)

    def _learn(self, unknown: pa.Array) -> np.ndarray:
        """Encode words that are not remembered; returns their numbers."""
        at = np.empty(len(unknown), np.int64)
        plain = pc.match_substring_regex(unknown, _LETTERS).to_numpy(zero_copy_only=False)
        for kind, letters in ((np.flatnonzero(plain), True), (np.flatnonzero(~plain), False)):
            for i in range(0, len(kind), LEARNED):
                mine = kind[i : i + LEARNED]
                words = unknown.take(pa.array(mine)).to_pylist()
                at[mine] = len(self.index) + np.arange(len(words))
                if letters:
                    flat, _ = self._coded([" ".join(words[j : j + JOINED]) for j in range(0, len(words), JOINED)])
                    ends = np.flatnonzero(self.last[flat]) + 1
                    if len(ends) != len(words):
                        raise ValueError("the vocabulary does not mark the ends of words")
                    lengths = np.diff(ends, prepend=0)
                else:
                    flat, lengths = self._coded(words)
                self._add(words, lengths, flat)
        return at

    def _coded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = [e.ids for e in found]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths

    def _gather(self, at: np.ndarray) -> np.ndarray:
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.starts[at] - (ends - lengths), lengths) + np.arange(total)]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each followed by the end id, and the texts' bounds."""
        prepared = pa.array([_prepared(t) for t in texts], pa.large_binary()).view(pa.large_string())
        pieces = pc.replace_substring_regex(prepared, _ENDED, r"\1 \2\3")
        pieces = pc.if_else(pc.match_substring(prepared, "<|"), prepared, pieces)
        words = pc.ascii_split_whitespace(pieces)
        per_text = np.diff(words.offsets.to_numpy())
        # Each distinct word of the run is looked up once; an empty one has no ids.
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary
        if len(self.index) > self.remembered:
            self._forget()
        at = np.fromiter(map(self.index.get, distinct.to_pylist(), repeat(-1)), np.int64, len(distinct))
        unknown = at < 0
        long = unknown & (pc.utf8_length(distinct).to_numpy(zero_copy_only=False) > LONGEST)
        new = np.flatnonzero(unknown & ~long)
        at[new] = self._learn(distinct.take(pa.array(new)))
        used = self.used
        new = np.flatnonzero(long)
        at[new] = self._learn(distinct.take(pa.array(new)))
        at = at[coded.indices.to_numpy()] if len(distinct) else at
        ids = self._gather(at)
        ends = np.r_[0, np.cumsum(self.lengths[at])][np.cumsum(per_text)]
        bounds = np.r_[0, ends + np.arange(1, len(texts) + 1)]
        # Long words are not remembered.
        for w in distinct.take(pa.array(new)).to_pylist():
            del self.index[w]
        self.used = used
        return np.insert(ids, ends, END_ID).astype("<u4", copy=False), bounds


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def id_bytes(path: str) -> int:
    """Bytes that hold any id of the vocabulary."""
    return 2 if encoder(path).tokenizer.get_vocab_size() <= 1 << 16 else 4


def encoded(
    column: pa.Array, path: str, most: int = 1 << 21
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs ``(first, last, ids, bounds)`` of a text column, about ``most`` bytes of text each.

    Only a run's texts are taken out of the column, and freed memory is given back after
    each, so that a worker needs no more for a large batch than for a small one.
    """
    encode = encoder(path).encode
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < len(column):
        before = int(ends[first - 1]) if first else 0
        last = min(int(np.searchsorted(ends, before + most)) + 1, len(column))
        run = column.slice(first, last - first).fill_null("").cast(pa.large_binary()).to_pylist()
        yield first, last, *encode(run)
        del run
        give_back()
        first = last
