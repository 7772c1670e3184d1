"""Cross-entropy difference: how much more like the target than like the background a text is.

Two bigram models are matched: one vocabulary, one smoothing, same order. The
target model is counted over target texts, the background model over all texts.
A text's score is the mean over its tokens of target loss minus background
loss, in bits; the lower, the more like the target.

The vocabulary is all words. A token's loss is that of its pair (word before,
word) less what its word before leans on, so whatever a token needs is known
where all rows of one of its two words meet. Pairs of two frequent words are
counted with partial aggregation and broadcast; every other token goes by
shuffle to a rarer word of its pair, as a row in a packed block, and what it
adds to its text comes back by shuffle to the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import bounded, materialise, mix, release, text_runs, word_hashes

# Pseudo-counts by which a word's successors lean on single words.
STRENGTH = 64.0
# A word is frequent with more than this share of all tokens, so no other word's rows
# are more than twice that share. Where pairs of frequent words outgrow HOT_PAIRS, fewer are frequent.
HOT_SHARE = 1 / 16384
HOT_PAIRS = 1 << 22
# Tokens (and texts) of a block of texts, and tokens that a group of words is to hold.
BLOCK_TOKENS, BLOCK_TEXTS = 1 << 21, 1 << 16
GROUP_TOKENS = 1 << 21
# All words beyond a vocabulary that the caller limits.
UNKNOWN = np.uint64(0)

_PACKED = "part int, block long, keys binary, counts binary, wide binary, narrow binary, texts binary, flags binary"
_ADDED = "block long, texts binary, target binary, background binary, rows binary"


def vocabulary(texts: DataFrame, words: int) -> np.ndarray:
    """Hashes of the most frequent words over all texts, sorted."""
    counted = word_counts(texts.withColumn("target", F.lit(False)), None)
    top = counted.orderBy(F.desc("n"), "word").limit(words).toArrow()
    return np.sort(top["word"].to_numpy().view(np.uint64))


def _blocks(batches: Iterator[pa.RecordBatch], known: np.ndarray | None, most: int = BLOCK_TOKENS):
    """Blocks of texts: word hashes, words per text, target flags, and the texts' first columns.

    Columns end with text and target.
    """
    held, tokens, rows = [], 0, 0
    for batch in batches:
        target = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
        for first, last, data, bounds in text_runs(batch.column(batch.num_columns - 2)):
            for a in range(first, last, BLOCK_TEXTS):
                b = min(a + BLOCK_TEXTS, last)
                if held and (tokens > most or rows + b - a > BLOCK_TEXTS):
                    yield _joined(held)
                    held, tokens, rows = [], 0, 0
                at = bounds[a - first : b - first + 1]
                hashes, words = word_hashes(data[at[0] : at[-1]], at - at[0])
                if known is not None and len(known):
                    i = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                    hashes = np.where(known[i] == hashes, hashes, UNKNOWN)
                elif known is not None:
                    hashes = np.full_like(hashes, UNKNOWN)
                held.append((hashes, np.diff(words), target[a:b], batch.slice(a, b - a)))
                tokens, rows = tokens + len(hashes), rows + b - a
    if held:
        yield _joined(held)


def _joined(held: list):
    hashes, n, target, batches = zip(*held, strict=True)
    return np.concatenate(hashes), np.concatenate(n), np.concatenate(target), batches


def word_counts(texts: DataFrame, known: np.ndarray | None) -> DataFrame:
    """``(word, n, target)``: tokens of every word in all and in target texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, n, target, _ in _blocks(batches, known, 2 * BLOCK_TOKENS):
            found, times = np.unique(hashes, return_counts=True)
            mine, its = np.unique(hashes[np.repeat(target, n)], return_counts=True)
            of_target = np.zeros(len(found), np.int64)
            of_target[np.searchsorted(found, mine)] = its
            yield pa.RecordBatch.from_pydict(
                {
                    "word": pa.array(found.view(np.int64)),
                    "n": pa.array(times.astype(np.int64)),
                    "target": pa.array(of_target),
                }
            )

    return (
        texts.select("text", "target").mapInArrow(count, "word long, n long, target long")
        .groupBy("word").agg(F.sum("n").alias("n"), F.sum("target").alias("target"))
    )


def _ranks(hot: np.ndarray, hashes: np.ndarray, n: np.ndarray):
    """Per token: its rank among frequent words and that of the word before, or -1.

    A text's first token follows the start mark, rank ``len(hot)``. Also which
    tokens are first and last.
    """
    rank = np.full(len(hashes), -1, np.int64)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)
        rank = np.where(hot[at] == hashes, at, -1)
    ends = np.cumsum(n)[n > 0]
    first, last = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    last[ends - 1] = True
    first[0:1], first[1:] = True, last[:-1]
    before = np.empty_like(rank)
    before[1:] = rank[:-1]
    before[first] = len(hot)
    return rank, before, last


def hot_pairs(texts: DataFrame, known: np.ndarray | None, hot: np.ndarray) -> DataFrame:
    """``(cell, n, target)`` of pairs of frequent words or marks.

    A cell is rank before * (hot + 1) + rank; the last rank is the start before a
    word and the end after one. Start and end make the cell of texts with a token.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = len(hot) + 1
        for hashes, n, target, _ in _blocks(batches, known):
            rank, before, last = _ranks(hot, hashes, n)
            mine = np.repeat(target, n)
            both, end = (rank >= 0) & (before >= 0), last & (rank >= 0)
            some = target[n > 0]
            cells = np.concatenate(
                [
                    before[both] * kinds + rank[both],
                    rank[end] * kinds + kinds - 1,
                    np.full(len(some), kinds * kinds - 1),
                ]
            )
            found, at = np.unique(cells, return_inverse=True)
            weights = np.concatenate([mine[both], mine[end], some])
            yield pa.RecordBatch.from_pydict(
                {
                    "cell": pa.array(found.astype(np.int64)),
                    "n": pa.array(np.bincount(at, minlength=len(found)).astype(np.int64)),
                    "target": pa.array(np.bincount(at, weights, len(found)).astype(np.int64)),
                }
            )

    return (
        texts.select("text", "target").mapInArrow(count, "cell long, n long, target long")
        .groupBy("cell").agg(F.sum("n").alias("n"), F.sum("target").alias("target"))
    )


class _Models:
    """What every task knows of both models (target, background): totals and frequent words."""

    def __init__(self, hot, single, totals, kinds, cells, pairs, strength):
        self.hot, self.totals, self.kinds, self.strength = hot, totals, kinds, strength
        k = len(hot) + 1
        self.single = [strength * (single[i] + 1.0) / (totals[i] + kinds) for i in (0, 1)]
        end = cells % k == k - 1
        inner, rank = cells[~end], cells[~end] % k
        self.cells = inner
        self.pair = [-np.log2(pairs[i][~end] + self.single[i][rank]) for i in (0, 1)]
        self.after = []
        for i in (0, 1):
            n = np.r_[single[i].astype(float), 0.0]
            # A word has no successor where its text ends; the start mark has one a text.
            at = cells[end] // k
            n[at] += np.where(at == k - 1, pairs[i][end], -pairs[i][end])
            self.after.append(np.log2(n + strength))


def _pack(models: _Models, known, parts: int, batches):
    """Rows for words that are not frequent, by part, and one row of the block's texts."""
    task, hot = TaskContext.get().partitionId() << 32, models.hot
    for block, (hashes, n, target, texts) in enumerate(_blocks(batches, known)):
        rank, before, last = _ranks(hot, hashes, n)
        text = np.repeat(np.arange(len(n)), n)
        word_hot, before_hot = rank >= 0, before >= 0
        both = word_hot & before_hot
        cell = np.searchsorted(models.cells, before[both] * (len(hot) + 1) + rank[both])
        sums = []
        for i in (0, 1):
            bits = np.zeros(len(hashes))
            bits[before_hot] = models.after[i][before[before_hot]]
            bits[both] += models.pair[i][cell]
            sums.append(np.bincount(text, bits, len(n)))
        ids = pa.chunked_array([b.column(0) for b in texts]).combine_chunks()
        listed = pa.RecordBatch.from_arrays(
            [ids, pa.array(n.astype(np.int64)), *map(pa.array, sums)], names=["id", "n", "target", "background"]
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, listed.schema) as out:
            out.write_batch(listed)
        rows = [(listing_part(task | block), sink.getvalue().to_pybytes(), *[b""] * 5)]
        before_hash = np.empty_like(hashes)
        before_hash[1:] = hashes[:-1]
        at = np.flatnonzero(~both)
        key = np.where(word_hot[at], before_hash[at], hashes[at])
        order = np.argsort(key)
        at, key = at[order], key[order]
        # 0: word after a rare one, 1: word after a frequent one or the start, 2: frequent word after key.
        what = np.where(word_hot[at], 2, before_hot[at].astype(np.int64))
        flags = (what + 4 * last[at] + 8 * np.repeat(target, n)[at]).astype(np.uint8)
        other = np.where(what == 2, rank[at], before[at]).astype("<u2")
        part = part_of(key, parts)
        edges = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(at)]
        for a, b in zip(edges, edges[1:], strict=False):
            if a < b:
                keys, counts = np.unique(key[a:b], return_counts=True)
                rare = what[a:b] == 0
                fields = (
                    keys, counts.astype("<u4"), before_hash[at[a:b]][rare], other[a:b][~rare],
                    text[at[a:b]].astype("<u2"), flags[a:b],
                )
                rows.append((int(part[a]), *(x.tobytes() for x in fields)))
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(columns[0], pa.int32()),
                pa.array(np.full(len(rows), task | block)),
                *[pa.array(c, pa.binary()) for c in columns[1:]],
            ],
            names=["part", "block", "keys", "counts", "wide", "narrow", "texts", "flags"],
        )


def listing_part(block: int) -> int:
    """A part of its own, below 0, for nearly every block's texts, however many tasks there are."""
    return -1 - int(mix(np.array([block], np.uint64))[0] >> np.uint64(34))


def part_of(key: np.ndarray, parts: int) -> np.ndarray:
    """Ascending with the key."""
    return ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _added(block, texts=b"", target=b"", background=b"", rows=b"") -> tuple:
    return block, texts, target, background, rows


def _add(models: _Models, table: pa.Table) -> pa.Table:
    """Bits that the rows of a group of words add to their texts, by block."""
    blocks = table["block"].to_numpy()
    names = _ADDED.replace(" long", "").replace(" binary", "").split(", ")

    def result(rows):
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        arrays = [pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]]
        return pa.Table.from_arrays(arrays, names=names)

    if table["part"][0].as_py() < 0:
        return result([_added(int(b), rows=r) for b, r in zip(blocks, table["keys"].to_pylist(), strict=True)])

    def read(name, kind):
        parts = [np.frombuffer(x, kind) for x in table[name].to_pylist()]
        return np.concatenate(parts), [len(x) for x in parts]

    (keys, _), (counts, _) = read("keys", "<u8"), read("counts", "<u4")
    (flags, sizes), (texts, _) = read("flags", "u1"), read("texts", "<u2")
    words, key = np.unique(keys, return_inverse=True)
    key = np.repeat(key, counts)
    what, last, target = flags & 3, (flags & 4) > 0, ((flags & 8) > 0).astype(float)
    narrow = read("narrow", "<u2")[0].astype(np.int64)
    other = np.empty(len(flags), np.int64)
    before, other[what == 0] = np.unique(read("wide", "<u8")[0], return_inverse=True)
    other[what > 0] = narrow
    span = max(len(before), len(models.hot) + 1)
    pairs, pair = np.unique((key * 3 + what) * span + other, return_inverse=True)
    own = what < 2
    bits = []
    for i in (0, 1):
        weight = (target, np.ones(len(flags)))[i]
        n = np.bincount(pair, weight, len(pairs))
        single = np.bincount(key[own], weight[own], len(words))
        after = np.log2(np.bincount(key[own & ~last], weight[own & ~last], len(words)) + models.strength)
        lean = (models.strength * (single + 1.0) / (models.totals[i] + models.kinds))[key]
        if (~own).any():
            lean[~own] = models.single[i][other[~own]]
        loss = -np.log2(n[pair] + lean)
        # The word after this one leans on it.
        loss[own & ~last] += after[key[own & ~last]]
        bits.append(loss)
    rows, at = [], 0
    for block, size in zip(blocks, sizes, strict=True):
        its, place = np.unique(texts[at : at + size], return_inverse=True)
        sums = [np.bincount(place, x[at : at + size]).astype("<f4").tobytes() for x in bits]
        rows.append(_added(int(block), its.tobytes(), *sums))
        at += size
    return result(rows)


def _finish(table: pa.Table) -> pa.Table:
    """The rows of a block's texts."""
    listed = next(x for x in table["rows"].to_pylist() if x)
    texts = pa.ipc.open_stream(listed).read_all()
    n = texts["n"].to_numpy()
    means, some = [], n > 0
    at = np.frombuffer(b"".join(table["texts"].to_pylist()), "<u2")
    for i, name in enumerate(("target", "background")):
        added = np.frombuffer(b"".join(table[name].to_pylist()), "<f4")
        sums = texts[name].to_numpy() + np.bincount(at, added, len(n))
        means.append(sums / np.maximum(n, 1))
    return pa.Table.from_arrays(
        [
            texts["id"],
            texts["n"],
            *[pa.array(x, mask=~some) for x in (*means, means[0] - means[1])],
        ],
        names=["_id", "n_tokens", "target_loss", "background_loss", "score"],
    )


def _columns(df: DataFrame, *names: str) -> list[np.ndarray]:
    found = df.select(*names).toArrow()
    return [found[x].to_numpy() for x in names]


def score(
    docs: DataFrame,
    target_ids: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int | None = None,
    strength: float = STRENGTH,
) -> DataFrame:
    """Per row: id, n_tokens, target_loss, background_loss, score (bits per token).

    ``target_ids`` has the ids of the target texts in its first column; all rows of
    ``docs`` are background. Null and empty texts have no token and null losses.
    Without target rows both models still hold the vocabulary and the target is
    the even distribution. Repeated target ids count once; null ids are no target.
    All words are scored; with ``words``, only so many, the most frequent, are told
    apart and the others are one unknown word.
    """
    spark = docs.sparkSession
    key = F.col(target_ids.columns[0])
    wanted = materialise(
        target_ids.select(key.alias("_target")).where("_target IS NOT NULL").distinct(), "targets"
    )
    limit = 64 << 20
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    flagged = (
        texts.join(bounded(wanted, limit), F.col("id") == F.col("_target"), "left")
        .select("id", "text", F.col("_target").isNotNull().alias("target"))
    )
    if wanted.bytes > limit:
        flagged = materialise(flagged, "flagged").df
    known = vocabulary(texts, words) if words is not None else None
    counted = materialise(
        word_counts(flagged, known), "words", metrics={"n": F.sum("n"), "target": F.sum("target")}
    )
    totals = [int(counted.metrics[k] or 0) for k in ("target", "n")]
    share = HOT_SHARE
    while True:
        hot, n, target = _columns(counted.df.where(F.col("n") > F.lit(totals[1] * share)), "word", "n", "target")
        order = np.argsort(hot.view(np.uint64))
        hot, single = hot.view(np.uint64)[order], [target[order], n[order]]
        pairs = materialise(hot_pairs(flagged, known, hot), "pairs")
        if pairs.rows <= HOT_PAIRS:
            break
        release(spark, pairs.path)
        share *= 4
    cells, n, target = _columns(pairs.df, "cell", "n", "target")
    order = np.argsort(cells)
    # One kind more than words: the unknown word.
    kinds = (counted.rows if known is None else len(known)) + 1
    release(spark, counted.path, pairs.path)
    shared = spark.sparkContext.broadcast(
        _Models(hot, single, totals, kinds, cells[order], [target[order], n[order]], strength)
    )
    parts = max(
        -(-totals[1] // GROUP_TOKENS), int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    )
    kind = docs.schema[id_col].dataType.simpleString()
    return (
        flagged.mapInArrow(lambda batches: _pack(shared.value, known, parts, batches), _PACKED)
        .groupBy("part").applyInArrow(lambda table: _add(shared.value, table), _ADDED)
        .groupBy("block").applyInArrow(
            _finish,
            f"_id {kind}, n_tokens long, target_loss double, background_loss double, score double",
        )
        .withColumnRenamed("_id", id_col)
    )
