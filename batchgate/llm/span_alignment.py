"""Where two tokenizers cut a text alike, by their own spans.

Tokenizer A is of the tokenizers library, B of sentencepiece; A sees a space
before the text, which B puts there itself. A's offsets count characters and B's
protos bytes of the text. These spans are coarse cuts: several tokens of one
character share its span, and byte-fallback tokens have none. There the
decoded bytes of the tokens tell where each ends.

Neither tokenizer joins anything across a single space before a visible
character, so a text falls into units there. A unit's groups and links are
found once and remembered by the worker.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import Table, bounded, materialise, release

# Units remembered by a worker, none longer than this; beyond the number all are forgotten.
REMEMBERED = 400_000
LONGEST = 64
# Units that are encoded at a time, and units of texts whose groups are put together at a time.
LEARNED = 4096
# Plain units that are encoded as one text: joined by spaces they fall into units again.
JOINED = 64
UNITS_AT_ONCE = 1 << 17
# Links that a task counts before it sends their sums on.
COUNTED = 1 << 21
# Frequent pairs whose counts every task looks up; others are joined by shuffle.
FREQUENT = 1 << 20

# Bytes that begin a visible character (of C2 and E1 to E3, some begin white space).
_VISIBLE = rb"[!-~\xc3-\xe0\xe4-\xf4]"
_PLAIN = re.compile(_VISIBLE + rb"[^ ]*", re.DOTALL)
_UNIT = re.compile(rb"(?<! ) (?=" + _VISIBLE + rb")")
_ODD = re.compile(rb"  | (?!" + _VISIBLE + rb")")


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level entry stands for."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


def units(text: bytes) -> list[bytes]:
    """A text that begins with a space, cut into units; the space before each is left out."""
    if _ODD.search(text) is None:
        return text.split(b" ")[1:]
    cuts = [m.start() for m in _UNIT.finditer(text)]
    if not cuts or cuts[0]:
        cuts = [0, *cuts]
    return [text[a + 1 : b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]


def refined(begin: np.ndarray, end: np.ndarray, sizes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Byte end of every token; tokens lie end to end, ``owner`` is the unit of each.

    ``begin`` and ``end`` are the spans, which leave out the places of tokens within a
    character. ``sizes`` are the decoded bytes of the tokens. A span that is as
    long as its token's bytes is taken as it is; tokens between two such spans
    end where their bytes do.
    """
    whole = end - begin == sizes
    total = np.cumsum(sizes)
    # How far the spans are ahead of the bytes at the last token whose span is whole.
    last = np.maximum.accumulate(np.where(whole, np.arange(len(sizes)), -1))
    known = last >= 0
    known[known] = owner[last[known]] == owner[known]
    ends = total.copy()
    ends[known] += (end - total)[last[known]]
    return ends


class Aligner:
    """Groups and links of texts; remembers units as scripts.

    A unit's script is its tokens in the order of its groups, each as four times its
    id plus what follows it: 0 a comma in A, 1 the bar, 2 a comma in B, 3 the end of
    a group.
    """

    def __init__(self, path_a: str, path_b: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = byte_level()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        # Decoded bytes of A's entries and B's pieces, end to end, and where each begins.
        self.bytes_a = _end_to_end(
            {i: bytes(byte_of.get(c, 0) for c in entry) for entry, i in vocabulary.items()}
        )
        self.bytes_b = _end_to_end({i: self._piece(i) for i in range(self.b.vocab_size())})
        self.entries_a, self.entries_b = len(self.bytes_a[1]) - 1, len(self.bytes_b[1]) - 1
        self.digits = _digits(max(self.entries_a, self.entries_b))
        self.remembered = remembered
        self._forget()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode("utf-8")

    def _forget(self) -> None:
        self.index: dict[bytes, int] = {}
        # Unit k is script[starts[k] : starts[k] + lengths[k]]; without tokens its bytes differ.
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.script, self.used = np.zeros(4096, np.uint32), 0

    def _learn(self, unknown: list[bytes]) -> None:
        """Plain units are encoded many at a time, as one text that falls into them again."""
        plain = [u for u in unknown if _PLAIN.fullmatch(u)]
        single = list(set(unknown).difference(plain))
        for some in ([plain[i : i + JOINED] for i in range(0, len(plain), JOINED)], [[u] for u in single]):
            again = self._encode(some) if some else []
            if again:
                self._encode([[u] for u in again], last=True)

    def _encode(self, runs: list[list[bytes]], last: bool = False) -> list[bytes]:
        """Learn the units of all runs; returns those of runs whose bytes differ, to be told apart."""
        strings = [b" ".join(r) for r in runs]
        texts = [s.decode("utf-8") for s in strings]
        raw = np.frombuffer(b" " + b" ".join(strings), np.uint8)
        sizes = np.fromiter(map(len, strings), np.int64, len(strings)) + 1
        base = np.cumsum(sizes) - sizes
        # A: offsets count the string's characters, its space included.
        coded = self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
        some = [e.ids for e in coded]
        many_a = np.fromiter(map(len, some), np.int64, len(some))
        ids_a = np.fromiter(chain.from_iterable(some), np.int64, int(many_a.sum()))
        spans = chain.from_iterable(chain.from_iterable([e.offsets for e in coded]))
        spans = np.fromiter(spans, np.int64, 2 * len(ids_a)).reshape(-1, 2)
        chars = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        own_a = np.repeat(np.arange(len(runs)), many_a)
        spans = chars[spans + np.searchsorted(chars, base)[own_a][:, None]]
        ends_a, sound_a = self._ends(spans[:, 0], spans[:, 1], ids_a, own_a, self.bytes_a, raw, base, sizes)
        # B: spans count bytes and leave out the space, which B puts before the text itself.
        coded = self.b.encode(texts, return_type="proto", num_threads=1)
        some = [[(p.id, p.begin, p.end) for p in e.pieces] for e in coded]
        many_b = np.fromiter(map(len, some), np.int64, len(some))
        spans = chain.from_iterable(chain.from_iterable(some))
        spans = np.fromiter(spans, np.int64, 3 * int(many_b.sum())).reshape(-1, 3)
        ids_b, own_b = spans[:, 0], np.repeat(np.arange(len(runs)), many_b)
        begin = base[own_b] + spans[:, 1] + 1
        begin[(np.cumsum(many_b) - many_b)[many_b > 0]] -= 1
        ends_b, sound_b = self._ends(begin, base[own_b] + spans[:, 2] + 1, ids_b, own_b, self.bytes_b, raw, base, sizes)
        # Tokens belong to the units whose bytes they have.
        units = list(chain.from_iterable(runs))
        many = np.fromiter(map(len, runs), np.int64, len(runs))
        size = np.fromiter(map(len, units), np.int64, len(units)) + 1
        starts = np.cumsum(size) - size
        sound = sound_a & sound_b
        sides = []
        for ids, owner, ends in ((ids_a, own_a, ends_a), (ids_b, own_b, ends_b)):
            kept = sound[owner]
            sides.append((ids[kept], np.searchsorted(starts, ends[kept] - 1, "right") - 1, ends[kept]))
        kept = np.repeat(sound | last | (many == 1), many)
        place = np.cumsum(kept) - 1
        known = [u for u, k in zip(units, kept.tolist(), strict=True) if k]
        self._store(known, *[(ids, place[owner], ends) for ids, owner, ends in sides])
        return [u for u, k in zip(units, kept.tolist(), strict=True) if not k]

    def _ends(self, begin, end, ids, owner, entries, raw, base, sizes):
        """Byte ends of all tokens, and of which units the tokens' bytes are the unit's."""
        data, cut = entries
        length = cut[ids + 1] - cut[ids]
        # How many bytes the tokens of each unit have; only units of as many can be sound.
        per_unit = np.zeros(len(sizes), np.int64)
        np.add.at(per_unit, owner, length)
        sound = per_unit == sizes
        kept = sound[owner]
        ids, owner, length = ids[kept], owner[kept], length[kept]
        # Places in the bytes of the sound units, laid end to end.
        moved = np.cumsum(np.where(sound, sizes, 0)) - np.where(sound, sizes, 0)
        shift = (moved - base)[owner]
        ends = np.zeros(len(kept), np.int64)
        ends[kept] = refined(begin[kept] + shift, end[kept] + shift, length, owner) - shift
        said = data[np.repeat(cut[ids] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))]
        wanted = raw[np.repeat(sound, sizes)]
        wrong = np.flatnonzero(said != wanted)
        if len(wrong):
            starts = moved[sound]
            sound[np.flatnonzero(sound)[np.searchsorted(starts, wrong, "right") - 1]] = False
        return ends, sound

    def _store(self, unknown, a, b) -> None:
        (ids_a, own_a, ends_a), (ids_b, own_b, ends_b) = a, b
        # Tokens have bytes, so their ends ascend; groups end where both have an end.
        last_a, last_b = np.isin(ends_a, ends_b), np.isin(ends_b, ends_a)
        group_a = np.cumsum(last_a) - last_a
        group_b = np.cumsum(last_b) - last_b
        code = np.r_[4 * ids_a + last_a, 4 * ids_b + 2 + last_b]
        order = np.argsort(np.r_[2 * group_a, 2 * group_b + 1], kind="stable")
        script = code[order].astype(np.uint32)
        lengths = np.bincount(own_a, minlength=len(unknown)) + np.bincount(own_b, minlength=len(unknown))
        n, k = len(self.index), len(unknown)
        if n + k > len(self.starts):
            self.starts = np.resize(self.starts, 2 * (n + k))
            self.lengths = np.resize(self.lengths, 2 * (n + k))
        if self.used + len(script) > len(self.script):
            self.script = np.resize(self.script, 2 * (self.used + len(script)))
        self.starts[n : n + k] = self.used + np.cumsum(lengths) - lengths
        self.lengths[n : n + k] = lengths
        self.script[self.used : self.used + len(script)] = script
        self.used += len(script)
        self.index.update(zip(unknown, range(n, n + k), strict=True))

    def align(self, texts: list[bytes]):
        """Per text tokens of A and B and groups; links (as a * |B| + b) end to end; digests."""
        words = [units(b" " + t) if t else [] for t in texts]
        flat = list(chain.from_iterable(words))
        if len(self.index) > self.remembered:
            self._forget()
        unknown = set(flat).difference(self.index)
        kept = [u for u in unknown if len(u) <= LONGEST]
        for at in range(0, len(kept), LEARNED):
            self._learn(kept[at : at + LEARNED])
        mark, used = len(self.index), self.used
        long = [u for u in unknown if len(u) > LONGEST]
        if long:
            self._learn(long)
        at = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        cut = np.r_[0, np.cumsum([len(w) for w in words])].astype(np.int64)
        starts, lengths = self.starts[at], self.lengths[at].astype(np.int64)
        bad = np.r_[0, np.cumsum(lengths == 0)]
        sound = bad[cut[1:]] == bad[cut[:-1]]
        counts, digests = np.zeros((len(texts), 3), np.int64), [""] * len(texts)
        links = [np.zeros(0, np.int64)]
        # A step is some texts, or a part of a long one.
        edges = np.unique(np.r_[cut, np.arange(0, len(flat), UNITS_AT_ONCE)])
        sums = [hashlib.sha256() if ok else None for ok in sound.tolist()]
        text, trailing = 0, [b""] * len(texts)
        for x, y in _steps(edges, UNITS_AT_ONCE):
            script = self._gather(starts[x:y], lengths[x:y])
            mark_of = script & 3
            places = np.r_[0, np.cumsum(lengths[x:y])]
            is_a = np.r_[0, np.cumsum(mark_of < 2)]
            ended = np.r_[0, np.cumsum(mark_of == 3)]
            said, where = self._said(script)
            linked = (script[mark_of == 1] >> 2).astype(np.int64) * self.entries_b + (script[mark_of == 3] >> 2)
            while text < len(texts) and cut[text + 1] <= x:
                text += 1
            for t in range(text, len(texts)):
                if cut[t] >= y:
                    break
                p, q = places[max(cut[t], x) - x], places[min(cut[t + 1], y) - x]
                if p == q or not sound[t]:
                    continue
                counts[t] += is_a[q] - is_a[p], (q - p) - (is_a[q] - is_a[p]), ended[q] - ended[p]
                links.append(linked[ended[p] : ended[q]])
                # The last group of a text has nothing after it.
                sums[t].update(trailing[t])
                sums[t].update(said[where[p] : where[q] - 1])
                trailing[t] = b";"
        for t, own in enumerate(sums):
            if own is not None and counts[t, 0]:
                digests[t] = own.hexdigest()
        # Long units are not remembered.
        for u in long:
            del self.index[u]
        self.used = used
        assert len(self.index) == mark
        return counts, np.concatenate(links), digests

    def _gather(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        ends = np.cumsum(lengths)
        n = int(ends[-1]) if len(ends) else 0
        return self.script[np.repeat(starts - (ends - lengths), lengths) + np.arange(n)]

    def _said(self, script: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The script in decimal, and where each of its tokens begins."""
        rows = np.empty((len(script), self.digits.shape[1] + 1), np.uint8)
        rows[:, :-1] = self.digits[script >> 2]
        rows[:, -1] = _AFTER[script & 3]
        shown = rows != 0
        return memoryview(rows[shown]), np.r_[0, np.cumsum(shown.sum(1))]


_AFTER = np.frombuffer(b",|,;", np.uint8)


def _end_to_end(entries: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    every = [entries.get(i, b"") for i in range(max(entries) + 1)]
    return np.frombuffer(b"".join(every), np.uint8), np.r_[0, np.cumsum([len(e) for e in every])]


def _digits(n: int) -> np.ndarray:
    """Decimal digits of the numbers below ``n``, zero bytes in front."""
    width = len(str(n))
    power = 10 ** np.arange(width)[::-1]
    ids = np.arange(n)[:, None]
    shown = (ids >= power) | (power == 1)
    return np.where(shown, ids // power % 10 + 0x30, 0).astype(np.uint8)


def _steps(edges: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges between the edges, as wide as they can be up to ``most``."""
    at = 0
    while at + 1 < len(edges):
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + most, "right")) - 1)
        yield int(edges[at]), int(edges[to])
        at = to


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    key = path_a, path_b
    if key not in _aligners:
        _aligners[key] = Aligner(*key)
    return _aligners[key]


def _runs(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    run, size, first = [], 0, 0
    for i, text in enumerate(column.cast(pa.large_binary())):
        run.append(text.as_py() or b"")
        size += len(run[-1])
        if size >= most or i + 1 == len(column):
            yield first, run
            run, size, first = [], 0, i + 1


def _aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        # Pairs of two vocabularies of some 2^16 entries take 32 bits.
        width = "<u4" if own.entries_a * own.entries_b <= 1 << 32 else "<i8"
        for batch in batches:
            for first, texts in _runs(batch.column(1)):
                counts, links, digests = own.align(texts)
                bounds = np.r_[0, np.cumsum(counts[:, 2])].astype(np.int64)
                raw = links.astype(width)
                packed = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(),
                    len(texts),
                    [None, pa.py_buffer(bounds * raw.itemsize), pa.py_buffer(raw)],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        *[pa.array(counts[:, k]) for k in range(3)],
                        pa.array(digests, pa.string()),
                        pa.array(np.full(len(texts), raw.itemsize, np.int32)),
                        packed.cast(pa.binary()),
                    ],
                    names=["id", "n_a", "n_b", "n_groups", "groups_sha256", "width", "links"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(
        run,
        f"id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, width int, links binary",
    )


def _unpacked(links: pa.Array, width: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All links of a column end to end, and the texts' bounds among them."""
    kind = np.dtype("<u4" if not len(width) or width[0].as_py() == 4 else "<i8")
    wide = links.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    bounds = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.view(kind).astype(np.int64), (bounds - bounds[0]) // kind.itemsize


def count_pairs(aligned: DataFrame, entries_b: int) -> Table:
    """(pair, n, best) of every linked pair of ids; ``best`` if no pair of its B id has more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0

        def sums():
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_pydict({"pair": pair, "n": n.astype(np.int64)})

        for batch in batches:
            held.append(_unpacked(batch.column(1), batch.column(0))[0])
            many += len(held[-1])
            if many >= COUNTED:
                yield sums()
                held, many = [], 0
        if many:
            yield sums()

    counts = materialise(
        aligned.select("width", "links").mapInArrow(count, "pair long, n long")
        .groupBy("pair").agg(F.sum("n").alias("n")),
        "pair-counts",
    )
    best = materialise(
        counts.df.groupBy((F.col("pair") % entries_b).alias("b")).agg(F.max("n").alias("most")), "best"
    )
    found = materialise(
        counts.df.withColumn("b", F.col("pair") % entries_b).join(bounded(best), "b")
        .select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
        .withColumn("step", F.floor(4 * F.log2("n")).cast("int")),
        "pairs",
    )
    release(aligned.sparkSession, counts.path, best.path)
    return found


def align(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    frequent: int = FREQUENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A link is a token of A and one of B that end at the same byte; its count says how
    often the two ids are linked in all texts. ``n_best`` are the links whose pair no
    other pair of the same B id exceeds. Texts that are null or empty, or that a
    tokenizer changes (B reads U+2581 as a space), have zeros and '' as digest.
    Repeated rows and null ids are rows like others and count as often as they
    stand. Units of very long texts are treated like any other, those over
    ``LONGEST`` bytes anew each time. An empty table gives no row. Other columns,
    whatever their names, play no part.

    Counts of up to ``frequent`` pairs are looked up by every task; links of rarer
    pairs, if there are any, are joined by shuffle, where none is frequent.
    """
    spark = docs.sparkSession
    entries_b = aligner(path_a, path_b).entries_b
    aligned = materialise(
        _aligned(docs, path_a, path_b, id_col, text_col)
        .withColumn("row", F.monotonically_increasing_id()),
        "aligned",
    )
    pairs = count_pairs(aligned.df, entries_b)
    # The lowest step from which on all pairs can be looked up.
    lowest, total = 1 << 30, 0
    for r in sorted(pairs.df.groupBy("step").count().collect(), key=lambda r: -r["step"]):
        total += r["count"]
        if total > frequent:
            break
        lowest = r["step"]
    top = pairs.df.where(F.col("step") >= lowest).select("pair", "n", "best").toArrow()
    order = np.argsort(top["pair"].to_numpy())
    listed = spark.sparkContext.broadcast(
        (
            top["pair"].to_numpy()[order],
            top["n"].to_numpy()[order],
            top["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64),
        )
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = listed.value
        for batch in batches:
            links, bounds = _unpacked(batch.column("links"), batch.column("width"))
            at = np.minimum(np.searchsorted(pair, links), max(len(pair) - 1, 0))
            known = pair[at] == links if len(pair) else np.zeros(len(links), bool)

            def summed(values: np.ndarray) -> pa.Array:
                sums = np.r_[0, np.cumsum(np.where(known, values, 0))]
                return pa.array((sums[bounds[1:]] - sums[bounds[:-1]]).astype(np.int64))

            rare = np.r_[0, np.cumsum(~known)][bounds]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    summed(best[at] if len(pair) else links),
                    summed(n[at] if len(pair) else links),
                    pa.ListArray.from_arrays(pa.array(rare.astype(np.int32)), pa.array(links[~known])),
                ],
                names=[*kept, "n_best", "count_sum", "rare"],
            )

    kept = ["row", "id", "n_a", "n_b", "n_groups", "groups_sha256"]
    kind = docs.schema[id_col].dataType.simpleString()
    scored = materialise(
        aligned.df.select(*kept, "width", "links").mapInArrow(
            score,
            f"row long, id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, "
            "n_best long, count_sum long, rare array<long>",
        ),
        "scored",
        metrics={"rare": F.sum(F.size("rare"))},
    )
    release(spark, aligned.path)
    found = scored.df.drop("rare")
    if scored.metrics["rare"]:
        added = (
            scored.df.select("row", F.explode("rare").alias("pair")).groupBy("row", "pair").count()
            .join(pairs.df.select("pair", "n", "best"), "pair")
            .groupBy("row").agg(
                F.sum(F.col("best").cast("long") * F.col("count")).alias("more_best"),
                F.sum(F.col("n") * F.col("count")).alias("more"),
            )
        )
        found = found.join(added, "row", "left").withColumns(
            {
                "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
                "count_sum": F.col("count_sum") + F.coalesce("more", F.lit(0)),
            }
        )
    return found.select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        "n_best", "count_sum", "groups_sha256",
    )
