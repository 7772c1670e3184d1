"""Merge-type SentencePiece encoding by a table of each prefix's last token.

The ids of a text are the only sequence in which every two neighbours stay
apart when merged on their own. So each prefix of a segment has one last token:
the match ending there whose left neighbour - the last token of what lies
before - is compatible with it. An automaton finds the matches in one pass, the
table is filled from left to right, and ids are recovered backwards. The distinct
segments of a run of texts go through it together, a byte of each at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import text_runs

SPACE = "▁"
END_ID = 2
# Segments remembered by a worker, none of more bytes than this, which are also those that are
# taken together; beyond the number half of it, the newest, stay.
REMEMBERED = 400_000
LONGEST = 64
# Segments taken together at most, and bytes of text in a run.
TOGETHER = 1 << 16
RUN = 1 << 21
PAIRS = 500_000
# The table of pairs of pieces has 2^21 places, half of which are used before it is cleared.
PLACES = 21
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class PrefixEncoder:
    """Encodes like the model's own library, with an end id."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.remembered = remembered
        lib = self.library
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        for i in range(lib.vocab_size()):
            if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i)):
                piece = lib.id_to_piece(i)
                self.ids[piece], self.score[piece] = i, lib.get_score(i)
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        joints = [p for p in self.ids if re.search(f"[^{SPACE}]{SPACE}", p) or " " in p or "\n" in p]
        if joints:
            raise ValueError("pieces span segments")
        # A piece that its own characters do not merge into is never a token.
        whole = [p for p in self.ids if self._merged(p) == [p]]
        self.automaton = ahocorasick.Automaton()
        for piece in whole:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.together: dict[tuple[str, str], bool] = {}
        self._tabulate(whole)
        self.decimals = pa.array([b"%d " % i for i in range(lib.vocab_size())], pa.large_binary())
        self.words: dict[bytes, bytes] = {}

    def _tabulate(self, pieces: list[str]) -> None:
        """The automaton over bytes as arrays; a space is one byte."""
        self.pieces = pieces
        coded = [p.replace(SPACE, " ").encode("utf-8") for p in pieces]
        self.piece_ids = np.array([self.ids[p] for p in pieces], np.int32)
        self.byte_ids = np.array(self.bytes, np.int32)
        self.size = np.array([len(c) for c in coded], np.int32)
        # A node's successors in the trie; the nodes of each depth; the piece that ends at a node.
        after: list[dict[int, int]] = [{}]
        levels: list[list[int]] = [[0]]
        ends = [0] * len(coded)
        for i, c in enumerate(coded):
            node = 0
            for depth, byte in enumerate(c, 1):
                if byte not in after[node]:
                    after[node][byte] = len(after)
                    if depth == len(levels):
                        levels.append([])
                    levels[depth].append(len(after))
                    after.append({})
                node = after[node][byte]
            ends[i] = node
        # Bytes of no piece share column 0, which leads back to the root.
        used = sorted(set().union(*coded))
        self.column = np.zeros(256, np.int32)
        self.column[used] = np.arange(1, len(used) + 1)
        self.step = np.zeros((len(after), len(used) + 1), np.min_scalar_type(len(after)))
        self.match = np.full(len(after), -1, np.int32)
        self.match[ends] = np.arange(len(coded))
        fail = np.zeros(len(after), np.int32)
        for depth, level in enumerate(levels):
            nodes = np.array(level)
            if depth:
                self.step[nodes] = self.step[fail[nodes]]
                own = self.match[nodes]
                self.match[nodes] = np.where(own < 0, self.match[fail[nodes]], own)
            links = [(n, b, to) for n in level for b, to in after[n].items()]
            if links:
                at, byte, to = np.array(links).T
                fail[to] = self.step[at, self.column[byte]]
                self.step[at, self.column[byte]] = to
        # The longest piece that is a proper suffix of each piece.
        self.shorter = self.match[fail[ends]]
        self.pairs, self.known = np.zeros(1 << PLACES, np.int64), 0

    def _merged(self, text: str) -> list[str]:
        """Repeatedly merge the leftmost pair of the best score: a pair's own history."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        known = self.together.get((left, right))
        if known is None:
            if len(self.together) > PAIRS:
                self.together.clear()
            known = self.together[left, right] = self._merged(left + right) == [left, right]
        return known

    def tokens(self, segment: str) -> list[str]:
        """Pieces of a segment; a character that no piece has is a token of its own."""
        last: list[str | None] = [None] * len(segment)
        get, slow = self.together.get, self.compatible
        for end, piece in self.automaton.iter(segment):
            if last[end] is not None:
                continue
            before = end - len(piece)
            if before < 0:
                last[end] = piece
                continue
            left = last[before]
            if left is None:
                left = last[before] = segment[before]
            known = get((left, piece))
            if known or known is None and slow(left, piece):
                last[end] = piece
        found, at = [], len(segment) - 1
        while at >= 0:
            piece = last[at] or segment[at]
            found.append(piece)
            at -= len(piece)
        return found[::-1]

    def _compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``compatible`` of many pairs of pieces' numbers, by a table with open addressing."""
        key = left.astype(np.int64) * len(self.pieces) + right + 1
        place = ((key.astype(np.uint64) * _SPREAD) >> np.uint64(64 - PLACES)).astype(np.int64)
        held = self.pairs[place]
        seek = np.flatnonzero(held >> 1 != key)
        while len(seek):
            seek = seek[held[seek] != 0]
            place[seek] = (place[seek] + 1) & ((1 << PLACES) - 1)
            held[seek] = self.pairs[place[seek]]
            seek = seek[held[seek] >> 1 != key[seek]]
        new = np.flatnonzero(held == 0)
        if len(new):
            distinct, first, again = np.unique(key[new], return_index=True, return_inverse=True)
            found = [
                self._merged(self.pieces[a] + self.pieces[b]) == [self.pieces[a], self.pieces[b]]
                for a, b in zip(left[new[first]].tolist(), right[new[first]].tolist(), strict=True)
            ]
            held[new] = np.array(found)[again]
            self._remember(distinct.tolist(), place[new[first]].tolist(), found)
        return (held & 1).astype(bool)

    def _remember(self, keys: list[int], places: list[int], found: list[bool]) -> None:
        if self.known + len(keys) > 1 << (PLACES - 1):
            self.pairs[:], self.known = 0, 0
            if len(keys) > 1 << (PLACES - 1):
                return
            places = [(k * int(_SPREAD) & (1 << 64) - 1) >> (64 - PLACES) for k in keys]
        for key, place, yes in zip(keys, places, found, strict=True):
            while self.pairs[place]:
                place = (place + 1) & ((1 << PLACES) - 1)
            self.pairs[place] = 2 * key + yes
        self.known += len(keys)

    def _filled(self, words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, none empty, end to end, and how many each has.

        A byte where no piece ends belongs to one that does, or to a character without a
        piece, which is compatible with anything and written as its bytes.
        """
        bounds, data = _buffers(words)
        start, size = bounds[:-1], np.diff(bounds)
        column = self.column[data]
        order = np.argsort(-size, kind="stable")
        start_of, left_over = start[order], np.cumsum(np.bincount(size)[::-1])[::-1]
        last = np.full(len(data), -1, np.int32)
        node = np.zeros(len(words), np.int32)
        for p in range(int(size.max(initial=0))):
            at = start_of[: left_over[p + 1]] + p
            node = self.step[node[: len(at)], column[at]]
            piece = self.match[node]
            undone = np.flatnonzero(piece >= 0)
            at, piece = at[undone], piece[undone]
            while len(at):
                length = self.size[piece]
                left = last[at - length]
                good = (length == p + 1) | (left < 0)
                ask = np.flatnonzero(~good)
                good[ask] = self._compatible(left[ask], piece[ask])
                last[at[good]] = piece[good]
                piece = self.shorter[piece]
                undone = np.flatnonzero(~good & (piece >= 0))
                at, piece = at[undone], piece[undone]
        ends = np.zeros(len(data), bool)
        first, at = start, bounds[1:] - 1
        while len(at):
            ends[at] = True
            at = at - np.where(last[at] < 0, 1, self.size[last[at]])
            more = at >= first
            first, at = first[more], at[more]
        last, data = last[ends], data[ends]
        ids = np.where(last < 0, self.byte_ids[data], self.piece_ids[last])
        return ids, np.diff(np.r_[0, np.cumsum(ends)][bounds])

    def _singly(self, word: bytes) -> bytes:
        ids = []
        for piece in self.tokens(word.decode("utf-8").replace(" ", SPACE)):
            known = self.ids.get(piece)
            if known is not None:
                ids.append(known)
            else:
                ids.extend(self.bytes[b] for b in piece.encode("utf-8"))
        return np.array(ids, np.int32).tobytes()

    def _learn(self, words: pa.LargeBinaryArray) -> list[bytes]:
        """The ids of each word, as 32-bit integers."""
        learnt = [b""] * len(words)
        long = pc.binary_length(words).to_numpy() > LONGEST
        for k in np.flatnonzero(long).tolist():
            learnt[k] = self._singly(words[k].as_py())
        short = np.flatnonzero(~long)
        for i in range(0, len(short), TOGETHER):
            mine = short[i : i + TOGETHER]
            ids, lengths = self._filled(words.take(pa.array(mine)))
            raw, cut = ids.tobytes(), (4 * np.r_[0, np.cumsum(lengths)]).tolist()
            for k, a, b in zip(mine.tolist(), cut, cut[1:], strict=False):
                learnt[k] = raw[a:b]
        return learnt

    def encode_run(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, memoryview, np.ndarray]:
        """Of all texts, without end ids: ids, their bounds, each id as decimals and a space, their bounds."""
        mark = SPACE.encode("utf-8")
        texts = [b" " + t.replace(mark, b" ") if t else t for t in texts]
        joined = b"".join(texts)
        bounds = np.r_[0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]
        data = np.frombuffer(joined, np.uint8)
        # Segments begin at texts, at runs of spaces, at line breaks and after these.
        cut = data == ord(" ")
        cut[1:] &= ~cut[:-1]
        line = data == ord("\n")
        cut |= line
        cut[1:] |= line[:-1]
        cut[bounds[:-1][np.diff(bounds) > 0]] = True
        cuts = np.r_[np.flatnonzero(cut), len(data)]
        per_text = np.searchsorted(cuts, bounds)
        del cut, line
        coded = _binary(cuts, joined).dictionary_encode()
        # Each distinct segment of the run is looked up once.
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.words.get, words))
        new = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(new, self._learn(coded.dictionary.take(pa.array(new, pa.int64()))), strict=True):
            found[i] = ids
            if len(words[i]) <= LONGEST:
                self.words[words[i]] = ids
        if len(self.words) > self.remembered:
            older = len(self.words) - self.remembered // 2
            self.words = dict(islice(self.words.items(), older, None))
        ids = np.frombuffer(b"".join(found), np.int32)
        ends = np.r_[0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)]
        said_ends, said = _buffers(self.decimals.take(pa.array(ids)))
        each = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(ids)).take(coded.indices)
        id_bounds = each.offsets.to_numpy()[per_text]
        said_ends, said = _buffers(_binary(said_ends[ends], said).take(coded.indices))
        return each.values.to_numpy(), id_bounds, memoryview(said), said_ends[per_text]

    def encode(self, text: bytes) -> tuple[list[int], bytes]:
        """Ids with the end id, and the same as decimals joined by one space."""
        ids, _, said, _ = self.encode_run([text])
        return [*ids.tolist(), END_ID], bytes(said) + b"%d" % END_ID


def _binary(bounds: np.ndarray, data) -> pa.LargeBinaryArray:
    """Consecutive parts of ``data``."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(data)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, buffers)


def _buffers(parts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and bytes of an array that begins at its buffers' beginning."""
    _, offsets, data = parts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[: len(parts) + 1] if len(parts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bounds, raw[: bounds[-1]]


_encoders: dict[str, PrefixEncoder] = {}


def encoder(path: str) -> PrefixEncoder:
    if path not in _encoders:
        _encoders[path] = PrefixEncoder(path)
    return _encoders[path]


def _hashed(*parts) -> str:
    found = hashlib.sha256()
    for part in parts:
        found.update(part)
    return found.hexdigest()


def round_trip(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row: id, n_tokens, ids_sha256, decoded_sha256.

    Null is empty text, which has the end id alone and decodes to empty text.
    Repeated rows and null ids are rows like others.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(model), b"%d" % END_ID
        for batch in batches:
            for first, last, data, bounds in text_runs(batch.column(1), RUN):
                raw, cut = data.tobytes(), bounds.tolist()
                texts = [raw[a:b] for a, b in zip(cut, cut[1:], strict=False)]
                ids, ends, said, said_ends = own.encode_run(texts)
                lists = [[*ids[a:b].tolist(), END_ID] for a, b in zip(ends, ends[1:], strict=False)]
                decoded = own.library.decode(lists, num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(np.diff(ends) + 1),
                        pa.array([_hashed(said[a:b], end) for a, b in zip(said_ends, said_ends[1:], strict=False)]),
                        pa.array([_hashed(t.encode("utf-8")) for t in decoded]),
                    ],
                    names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string"))
        .mapInArrow(
            encode, f"_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
        )
        .withColumnRenamed("_id", id_col)
    )
