"""Exact n-gram Jaccard join: components of texts that share enough word shingles.

1. Every text becomes a set of shingle hashes. Equal sets are one class.
2. Two sets similar enough share one of their rarest shingles: the first
   ``n - ceil(t n) + 1`` in any order that is the same for all. Classes meet in
   groups by these shingles; frequent shingles come last, so groups stay small.
   A class is named by 64 bits of its digest, so copies need no lookup, and a
   shingle is moved once, with that name and the set's size.
3. Parity sketches leave the pairs of a group that may be similar enough: a token
   that only one of two sets has changes one bit at most. All of a group are first
   compared with its smallest name, which copies have in common in most of their
   groups; groups that this leaves in several components are compared pair by pair.
   The pairs' connected components are blocks; every link is in a block.
4. Texts are moved once, to their block, and made sets there: a text takes less than
   half of its hashes' bytes. A signature tree per block is joined
   with itself and links are verified on the sets. Larger blocks are dealt out in
   chunks: first each chunk with some hubs of the block; then chunks of sets that
   are not in the block's main component meet all others of sizes that can link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from batchgate.llm.common import (
    Table,
    bounded,
    connected,
    materialise,
    mix,
    release,
    settled,
    text_runs,
    word_hashes,
)
from batchgate.llm.signature_tree import Components, link, signature

# Frequent shingles that are put last. Only the order depends on them, never a result.
FREQUENT = 1 << 18
SEEN_TOGETHER = 3
OFTEN = 8
# Bytes of text hashed at a time; arrays of up to 30 times their size stay in a worker's cache.
RUN = 1 << 18
# Hashes that a task counts at a time.
COUNTED = 1 << 19
# Classes that a task remembers having met.
REMEMBERED = 1 << 16
# Groups beyond this size become part of one block without a look at sketches ...
LARGE_GROUP = 128
# ... by themselves; in the join it takes one beyond this size.
MOST_SCREENED = 4096
# Lists up to this size are compared one pair at a time.
FEW = 32
# Sets of a block that one task compares; blocks beyond it are dealt out in chunks.
CHUNK = 64
MOST_IN_CHUNK = 4096
HUBS = 8
# Bytes of the sets of one side of a unit, unless a single set has more.
UNIT_BYTES = 32 << 20
# Sizes of linked sets differ by a factor of whole/part at most, which is this many bands.
BANDS = 2
_FREQUENT_BITS = 22
# A sketch has so many bits for each token that linked sets may differ in.
SKETCH_BITS = 4


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Runs of texts as sorted distinct hashes of their shingles; a short text is one."""
    for first, last, data, bounds in text_runs(column, RUN):
        hashes, words = word_hashes(data, bounds, step=RUN)
        rolled = mix(hashes)
        for k in range(1, size):
            rolled = mix(rolled[:-1] + hashes[k:]) if len(rolled) > 1 else rolled[:0]
        found = []
        for a, b in zip(words[:-1].tolist(), words[1:].tolist(), strict=True):
            if b - a >= size:
                found.append(np.unique(rolled[a : b - size + 1]))
            elif b > a:
                whole = np.uint64(b - a) + np.zeros(1, np.uint64)
                for h in hashes[a:b]:
                    whole = mix(whole + h)
                found.append(whole)
            else:
                found.append(np.zeros(0, np.uint64))
        yield first, found


def _frequent(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``FREQUENT`` shingles that many texts have, with their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0

        def flush():
            together = np.concatenate(held)
            held.clear()
            found, n = np.unique(together, return_counts=True)
            some = n >= SEEN_TOGETHER
            return pa.RecordBatch.from_pydict(
                {"token": pa.array(found[some].view(np.int64)), "n": pa.array(n[some])}
            )

        for batch in batches:
            for _, sets in shingle_sets(batch.column(0), size):
                held += sets
                many += sum(map(len, sets))
                if many > COUNTED:
                    yield flush()
                    many = 0
        if many:
            yield flush()

    counts = materialise(
        docs.select("text").mapInArrow(settled(count), "token long, n long")
        .groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)
        .withColumn("step", F.floor(4 * F.log2("n"))),
        "frequent",
    )
    # The lowest step from which on no more than `FREQUENT` shingles are left.
    lowest, total = None, 0
    for r in sorted(counts.df.groupBy("step").count().collect(), key=lambda r: -r["step"]):
        total += r["count"]
        if total > FREQUENT:
            break
        lowest = r["step"]
    top = counts.df.where(F.col("step") >= lowest if lowest is not None else F.lit(False)).toArrow()
    release(docs.sparkSession, counts.path)
    tokens = top["token"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top["n"].to_numpy()[order]


def sketch(tokens: np.ndarray, part: int, whole: int) -> bytes:
    """The parity of the number of tokens at each of 2^k places; halves fold by XOR."""
    differ = 2 * len(tokens) * (whole - part) // (whole + part)
    bits = 1 << min(max(int(SKETCH_BITS * differ - 1).bit_length(), 6), 17)
    held = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((held & 1).astype(np.uint8), bitorder="little").tobytes()


def _described(docs: DataFrame, size: int, part: int, whole: int) -> DataFrame:
    """Per text: id, hashes of text and set, set size, sketch, rarest shingles, row.

    ``node`` is half of the digest of the set, as a number.
    """
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(docs, size))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, counts = frequent.value
        marked = np.zeros(1 << _FREQUENT_BITS, bool)
        marked[(often >> np.uint64(64 - _FREQUENT_BITS)).astype(np.int64)] = True

        def rarest(tokens: np.ndarray) -> np.ndarray:
            n = len(tokens)
            keep = n + (-part * n) // whole + 1  # n - ceil(t n) + 1
            maybe = np.flatnonzero(marked[(tokens >> np.uint64(64 - _FREQUENT_BITS)).astype(np.int64)])
            if not len(maybe):
                return tokens[:keep]
            at = np.minimum(np.searchsorted(often, tokens[maybe]), len(often) - 1)
            weight = np.zeros(n, np.int64)
            weight[maybe] = np.where(often[at] == tokens[maybe], counts[at], 0)
            return tokens[np.argsort(weight, kind="stable")[:keep]]

        seen: set[bytes] = set()

        def fresh(name: bytes | None) -> bool:
            if name is None or name in seen:
                return False
            if len(seen) >= REMEMBERED:
                seen.clear()
            seen.add(name)
            return True

        for batch in batches:
            for first, sets in shingle_sets(batch.column(2), size):
                sizes = np.array([len(s) for s in sets], np.int64)
                classes = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                # Copies that this task has met need not bring their class's shingles again.
                prefix = [rarest(s) if fresh(c) else s[:0] for s, c in zip(sets, classes, strict=True)]
                offsets = np.r_[0, np.cumsum([len(p) for p in prefix])]
                flat = np.concatenate(prefix) if prefix else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(sets)),
                        batch.column(1).slice(first, len(sets)),
                        pa.array(sizes),
                        pa.array(classes, pa.binary()),
                        pa.array([c and int.from_bytes(c[:8], "little", signed=True) for c in classes], pa.int64()),
                        pa.array([sketch(s, part, whole) for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64))),
                        batch.column(3).slice(first, len(sets)),
                    ],
                    names=["id", "text_hash", "n", "class", "node", "sketch", "rarest", "row"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", F.xxhash64("text").alias("text_hash"), "text", "row").mapInArrow(
        settled(describe),
        f"id {kind}, text_hash long, n long, class binary, node long, sketch binary, "
        "rarest array<long>, row long",
    )


def _edges(rows: list[int], known: Components) -> dict[str, pa.Array]:
    root = known.roots()
    own = np.array(rows, np.int64)
    moved = root != np.arange(len(own))
    return {"a": pa.array(own[root[moved]]), "b": pa.array(own[moved])}


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[dict]]:
    """Rows of one key after another; they arrive sorted by their first ``keys`` columns."""

    def rows():
        for batch in batches:
            yield from batch.to_pylist()

    for _, some in groupby(rows(), key=lambda r: tuple(r.values())[:keys]):
        yield list(some)


def _with_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[dict]:
    """Rows with the set of their text, the last column, as ``tokens``."""
    for batch in batches:
        texts, rest = batch.column(batch.num_columns - 1), batch.select(batch.schema.names[:-1])
        for first, sets in shingle_sets(texts, size):
            for row, tokens in zip(rest.slice(first, len(sets)).to_pylist(), sets, strict=True):
                yield row | {"tokens": tokens}


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of longs as arrays of whole groups; they arrive sorted by the first column."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        columns = tuple(c.to_numpy() for c in batch.columns)
        cut = np.searchsorted(columns[0], columns[0][-1]) if len(columns[0]) else 0
        if cut or (held and held[0][0][0] != columns[0][0]):
            yield tuple(map(np.concatenate, zip(*held, tuple(c[:cut] for c in columns), strict=True)))
            held = []
        if len(columns[0]):
            # Of repeated rows, sorted as they are, one is kept.
            new = np.ones(len(columns[0]) - cut, bool)
            new[1:] = np.any([c[cut + 1 :] != c[cut:-1] for c in columns], axis=0)
            held.append(tuple(c[cut:][new] for c in columns))
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _meeting(part: int, whole: int, most: int | None = None) -> Callable:
    """Groups of classes that share a shingle, as lists, or edges to their smallest node.

    Groups of over ``most`` classes (``LARGE_GROUP`` if not given) are edges. Rows are (key, n, node), sorted. A group is cut where sizes are too far apart to link.
    Lists are named by 128 bits, so that equal ones are found.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = most or LARGE_GROUP
        for key, n, node in _runs(batches):
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
            key, n, node = key[fresh], n[fresh], node[fresh]
            starts = np.ones(len(key), bool)
            starts[1:] = (key[1:] != key[:-1]) | (part * n[1:] > whole * n[:-1])
            begin = np.flatnonzero(starts)
            many = np.diff(begin, append=len(key))
            large = np.flatnonzero(many > limit)
            hubs = np.repeat([node[a : a + c].min() for a, c in zip(begin[large], many[large], strict=True)], many[large])
            owned = np.repeat(many > limit, many)
            hidden = mix(node.view(np.uint64))
            again = mix(hidden + np.uint64(1))
            x, y = (np.add.reduceat(h, begin) if len(begin) else h for h in (hidden, again))
            # Lists that this run has already are left out.
            small = np.flatnonzero((many > 1) & (many <= limit))
            _, one = np.unique(np.stack([x[small], y[small]]), axis=1, return_index=True) if len(small) else (0, small)
            small = small[np.sort(one)]
            lists = [node[a : a + c] for a, c in zip(begin[small], many[small], strict=True)]
            edges = int(owned.sum())
            ends = np.cumsum(many[small])
            yield pa.RecordBatch.from_pydict(
                {
                    "x": pa.array(np.r_[x[small].view(np.int64), np.zeros(edges, np.int64)]),
                    "y": pa.array(np.r_[y[small].view(np.int64), np.zeros(edges, np.int64)]),
                    "a": pa.array([None] * len(small) + hubs.tolist(), pa.int64()),
                    "nodes": pa.ListArray.from_arrays(
                        pa.array(np.r_[0, ends, (ends[-1] if len(ends) else 0) + 1 + np.arange(edges)], pa.int32()),
                        pa.array(np.concatenate([*lists, node[owned]]).astype(np.int64, copy=False)),
                    ),
                }
            )

    return run


def _folded(value: int, bits: int, to: int) -> int:
    while bits > to:
        bits //= 2
        value = (value >> bits) ^ (value & ((1 << bits) - 1))
    return value


def _with_hub(part: int, whole: int) -> Callable:
    """Those edges from a hub to another set whose sketches allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passed = np.zeros(batch.num_rows, bool)
            rows = zip(*(batch.column(c).to_pylist() for c in range(2, 6)), strict=True)
            for i, (n, held, hub_n, hub_held) in enumerate(rows):
                if part * max(n, hub_n) > whole * min(n, hub_n):
                    continue
                bits, hub_bits = 8 * len(held), 8 * len(hub_held)
                own, other = int.from_bytes(held, "little"), int.from_bytes(hub_held, "little")
                to = min(bits, hub_bits)
                differ = (_folded(own, bits, to) ^ _folded(other, hub_bits, to)).bit_count()
                passed[i] = differ * (whole + part) <= (n + hub_n) * (whole - part)
            yield batch.select(["a", "b"]).filter(pa.array(passed))

    return run


def _possible(part: int, whole: int) -> Callable:
    """Edges that connect the sets of a group whose sketches allow a link.

    Rows of one label are one component already.
    """

    def of_few(sizes: list[int], sketches: list[bytes], known: Components) -> None:
        bits = [8 * len(s) for s in sketches]
        values = [int.from_bytes(s, "little") for s in sketches]
        for i, n in enumerate(sizes):
            for j in range(i + 1, len(sizes)):
                if part * sizes[j] > whole * n:
                    break
                if known.find(i) == known.find(j):
                    continue
                to = min(bits[i], bits[j])
                differ = (_folded(values[i], bits[i], to) ^ _folded(values[j], bits[j], to)).bit_count()
                if differ * (whole + part) <= (n + sizes[j]) * (whole - part):
                    known.union(i, j)

    def of_many(sizes: list[int], sketches: list[bytes], known: Components) -> None:
        n, label = np.array(sizes, np.int64), known.roots()
        words = np.array([len(s) // 8 for s in sketches])
        kinds = [np.flatnonzero(words == w) for w in np.unique(words)]
        for x, first in enumerate(kinds):
            rows = np.frombuffer(b"".join([sketches[i] for i in first]), np.uint64).reshape(len(first), -1)
            for second in kinds[x:]:
                held = np.frombuffer(b"".join([sketches[i] for i in second]), np.uint64).reshape(len(second), -1)
                while held.shape[1] > rows.shape[1]:
                    held = held[:, : held.shape[1] // 2] ^ held[:, held.shape[1] // 2 :]
                for i, own in zip(first.tolist(), rows, strict=True):
                    near = (part * n[second] <= whole * n[i]) & (part * n[i] <= whole * n[second])
                    open_ = np.flatnonzero(near & (label[second] != label[i]))
                    differ = np.bitwise_count(held[open_] ^ own).sum(1, dtype=np.int64)
                    for j in second[open_[differ * (whole + part) <= (n[i] + n[second[open_]]) * (whole - part)]].tolist():
                        if label[j] != label[i]:
                            known.union(i, j)
                            label[label == label[j]] = label[i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, 1):
            rows.sort(key=lambda r: r["n"])
            ids, sizes, sketches = ([r[c] for r in rows] for c in ("row", "n", "sketch"))
            known = Components(np.array([r.get("label", r["row"]) for r in rows], np.int64))
            (of_few if len(ids) <= FEW else of_many)(sizes, sketches, known)
            yield pa.RecordBatch.from_pydict(_edges(ids, known))

    return run


def _verified(size: int, part: int, whole: int) -> Callable:
    """Edges that connect the linked sets of a unit, verified on the sets of its texts.

    A unit's rows are of side 0, 1 or 2: sets of side 0 meet one another and those
    of side 2, as do those of side 1. Rows of one label are one component already.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, some in groupby(_with_sets(batches, size), key=lambda r: tuple(r.values())[:3]):
            rows = list(some)
            ids = [r["row"] for r in rows]
            sets = [r["tokens"] for r in rows]
            bits = [signature(s) for s in sets]
            sizes = np.array([len(s) for s in sets], np.int64)
            side = np.array([r["side"] for r in rows])
            known = Components(np.array([r["label"] for r in rows], np.int64))

            def linked(p: int, q: int) -> bool:
                a, b = (sets[p], sets[q]) if sizes[p] <= sizes[q] else (sets[q], sets[p])
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                both = int((b[at] == a).sum())
                return whole * both >= part * (len(a) + len(b) - both)

            sides = [np.flatnonzero(side == s) for s in range(3)]
            for x, y in ((0, 0), (0, 2), (1, 2)):
                if len(sides[x]) and len(sides[y]):
                    link(bits, sizes, sides[x], sides[y], part, whole, known, linked)
            yield pa.RecordBatch.from_pydict(_edges(ids, known))

    return run


def _groups(rows: DataFrame, part: int, whole: int) -> Table:
    """Lists of classes that share a prefix shingle, or edges of large groups."""
    return materialise(
        rows.where("n > 0").select(F.explode("rarest").alias("key"), "n", "node")
        .repartition("key").sortWithinPartitions("key", "n", "node")
        .mapInArrow(settled(_meeting(part, whole, MOST_SCREENED)), "x long, y long, a long, nodes array<long>"),
        "groups",
        metrics={"large": F.count("a")},
    )


def _blocks(rows: DataFrame, groups: Table, part: int, whole: int) -> Table:
    """(node, root) of classes that may be linked; root names the block."""
    spark = rows.sparkSession
    # Groups of the same classes need one look.
    members = materialise(
        groups.df.where("a IS NULL").groupBy("x", "y").agg(F.first("nodes").alias("nodes"))
        .select(F.monotonically_increasing_id().alias("key"), "nodes")
        .select("key", F.array_min("nodes").alias("hub"), F.size("nodes").alias("many"), F.explode("nodes").alias("row")),
        "members",
    )
    # Mostly there is no large group.
    large = groups.metrics["large"] and materialise(
        groups.df.where("a IS NOT NULL").select("a", F.col("nodes")[0].alias("b")).where("a != b").distinct(),
        "large-groups",
    )
    release(spark, groups.path)
    wanted = materialise(members.df.select("row").distinct(), "wanted-sketches")
    sketches = materialise(
        rows.select(F.col("node").alias("row"), "n", "sketch")
        .join(bounded(wanted), "row", "left_semi").dropDuplicates(["row"]),
        "sketches",
        F.octet_length("sketch"),
    )
    hubs = bounded(sketches).select(F.col("row").alias("hub"), F.col("n").alias("hub_n"), F.col("sketch").alias("hub_sketch"))
    first = materialise(
        members.df.where("row != hub").select("hub", "row").distinct()
        .join(bounded(sketches), "row").join(hubs, "hub")
        .select(F.col("hub").alias("a"), F.col("row").alias("b"), "n", "sketch", "hub_n", "hub_sketch")
        .mapInArrow(settled(_with_hub(part, whole)), "a long, b long"),
        "with-hub",
    )
    edges = first.df.union(large.df) if large else first.df
    # Classes with one smallest hub are one component.
    known = materialise(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "smallest-hubs")
    labelled = materialise(
        members.df.where("many > 2").select("key", "row")
        .join(bounded(known), F.col("row") == F.col("node"), "left")
        .select("key", "row", F.least("root", "row").alias("label")),
        "labelled-members",
    )
    several = materialise(
        labelled.df.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a != b").select("key"),
        "several",
    )
    release(spark, members.path, wanted.path, known.path)
    rest = materialise(
        labelled.df.join(bounded(several), "key", "left_semi").join(bounded(sketches), "row")
        .select("key", "row", "n", "sketch", "label")
        .repartition("key").sortWithinPartitions("key")
        .mapInArrow(settled(_possible(part, whole)), "a long, b long"),
        "possible",
    )
    blocks = connected(rest.df.union(edges))
    release(spark, sketches.path, labelled.path, several.path, rest.path, first.path, *([large.path] if large else []))
    return blocks


def _band(part: int, whole: int) -> float:
    """Width of a band of logarithms of sizes, a little over the exact one for rounding."""
    return max(log(whole / part), 1e-6) * (1 + 1e-9) / BANDS


def _linked(sets: Table, size: int, part: int, whole: int) -> Table:
    """(node, root) of classes that are linked; ``sets`` has block, size of it, row, n, text."""
    spark, verify = sets.df.sparkSession, _verified(size, part, whole)
    sort = ["block", "x", "y"]
    chunks = F.ceil(F.col("members") / CHUNK)
    spread = F.xxhash64("row")
    # First round: each chunk for itself, with the block's hubs in every chunk.
    own = sets.df.withColumn("chunks", F.when(F.col("members") <= CHUNK, 1).otherwise(chunks))
    hub = (F.col("hub_rank") <= HUBS) & (F.col("chunks") > 1)
    placed = own.withColumn(
        "x",
        F.explode(
            F.when(hub, F.sequence(F.lit(0).cast("long"), F.col("chunks").cast("long") - 1)).otherwise(
                F.array(F.pmod(spread, F.col("chunks")))
            )
        ),
    )
    shape = "row", F.lit(0).alias("side"), F.col("row").alias("label"), "text"
    first = materialise(
        placed.select("block", "x", F.lit(0).cast("long").alias("y"), *shape)
        .repartition(*sort).sortWithinPartitions(*sort, "row")
        .mapInArrow(settled(verify), "a long, b long"),
        "links",
    )
    if not sets.metrics["largest"] or sets.metrics["largest"] <= CHUNK:
        release(spark, sets.path)
        links = connected(first.df)
        release(spark, first.path)
        return links

    # Second round, in larger blocks only: sets beside the main component meet all others.
    so_far = connected(first.df)
    big = materialise(
        own.where("chunks > 1").select("block", "row", "members", "n", "text")
        .join(bounded(so_far), F.col("row") == F.col("node"), "left")
        .withColumn("label", F.coalesce("root", "row")).drop("node", "root")
        .withColumn("band", F.floor(F.log("n") / _band(part, whole))),
        "big-blocks",
        codec="zstd",
    )
    release(spark, so_far.path, sets.path)
    main = materialise(
        big.df.groupBy("block", "label").count()
        .groupBy("block").agg(F.max_by("label", F.struct("count", "label")).alias("main")),
        "main-components",
    )
    # Chunks grow with the block up to a number and a size, so that sets are copied to few
    # tasks. A chunk lies in one band of sizes, and links join bands near each other only.
    # Sets beside the main component have chunks of their own: all others go to each of these.
    wide = F.least(F.greatest(F.lit(CHUNK), F.ceil(F.col("members") / 16)), F.lit(MOST_IN_CHUNK))
    fit = F.greatest(F.floor(UNIT_BYTES / (8 * F.col("longest"))), F.lit(1))
    placed = big.df.join(bounded(main), "block").withColumn("beside", F.col("label") != F.col("main"))
    bands = materialise(
        placed.groupBy("block", "band", "beside").agg(
            F.count(F.lit(1)).alias("held"), F.max("members").alias("members"), F.max("n").alias("longest")
        ).select("block", "band", "beside", F.ceil(F.col("held") / F.least(wide, fit)).cast("long").alias("chunks")),
        "bands",
    )
    dealt = materialise(
        placed.join(bounded(bands), ["block", "band", "beside"])
        .withColumn("chunk", F.col("band") * F.lit(1 << 32) + 2 * F.pmod(spread, F.col("chunks")) + F.col("beside").cast("long"))
        .select("block", "band", "chunk", "row", "label", "text", "beside"),
        "chunks",
        codec="zstd",
    )
    release(spark, big.path, main.path, bands.path)
    near_by = F.explode(F.sequence(F.col("band") - BANDS, F.col("band") + BANDS))
    reach = materialise(
        dealt.df.groupBy("block", "band", "chunk")
        .agg(F.max("beside").alias("beside"), F.max(~F.col("beside")).alias("main"))
        .withColumn("band", near_by).groupBy("block", "band").agg(
            F.collect_list(F.struct("chunk", "main")).alias("every"),
            F.collect_list(F.when(F.col("beside"), F.col("chunk"))).alias("with_beside"),
        ),
        "reach",
        32 * (F.size("every") + F.size("with_beside")),
    )
    # Unit (x, y): sets beside the main component of chunk x against those of chunk y.
    # Two sets beside it meet in the unit with x <= y.
    placed = dealt.df.join(bounded(reach), ["block", "band"])
    left = (
        placed.where("beside").withColumn("to", F.explode("every"))
        .withColumn("x", F.col("chunk")).withColumn("y", F.col("to.chunk"))
        .where("x <= y OR to.main")
        .withColumn("side", F.when(F.col("x") == F.col("y"), 0).otherwise(1))
    )
    right = (
        placed.withColumn("x", F.explode("with_beside")).withColumn("y", F.col("chunk"))
        .where("x < y OR NOT beside").withColumn("side", F.lit(2))
    )
    columns = [*sort, "row", "side", "label", "text"]
    second = materialise(
        left.select(*columns).union(right.select(*columns))
        .repartition(*sort).sortWithinPartitions(*sort, "row")
        .mapInArrow(settled(verify), "a long, b long"),
        "links",
    )
    release(spark, dealt.path, reach.path)
    links = connected(first.df.union(second.df))
    release(spark, first.path, second.path)
    return links


def components(
    docs: DataFrame,
    size: int,
    part: int,
    whole: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id``, the smallest id reachable by links.

    Words are runs of anything but ASCII white space, A-Z in lower case; a set
    holds the distinct shingles of ``size`` words, or the whole text if it has fewer.
    Sets link when ``whole`` * intersection >= ``part`` * union. Texts that are null or
    have no word have an empty set and link with nothing. Repeated rows are rows
    like others; a null id is in a component but never names it unless all its
    ids are null. An empty table gives no row.
    """
    rows, named = _members(docs, size, part, whole, id_col, text_col, None)
    return rows.join(named, "class", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("best.i")).otherwise(F.col("id")).alias("component_id"),
    )


def _members(docs, size, part, whole, id_col, text_col, row_col) -> tuple[DataFrame, DataFrame]:
    """Rows with the class of their set, and (class, best row of its component)."""
    texts = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        (F.col(row_col) if row_col else F.lit(0)).cast("long").alias("row"),
    )
    described = _described(texts, size, part, whole)
    if not row_col:
        described = described.withColumn("row", F.monotonically_increasing_id())
    texts_table = materialise(described, "texts")
    order = F.struct(F.col("id").isNull().alias("u"), F.col("id").alias("i"), F.col("row").alias("r"), F.col("text_hash").alias("t"))
    classes = materialise(
        texts_table.df.where("n > 0").groupBy("class", "node").agg(F.min(order).alias("best"), F.max("n").alias("n"))
        .select("class", "best", "n", F.col("node").alias("row")),
        "classes",
    )
    groups = _groups(texts_table.df, part, whole)
    # Prefixes are most of the table, and not needed any more.
    rows = materialise(texts_table.df.drop("rarest", "text_hash"), "rows").df
    release(docs.sparkSession, texts_table.path)
    blocks = _blocks(rows, groups, part, whole)

    # The sets of classes in blocks are made anew from their texts, where they meet.
    sizes = materialise(blocks.df.groupBy("root").agg(F.count(F.lit(1)).alias("members")), "block-sizes", metrics={"largest": F.max("members")})
    hubs = blocks.df.join(
        bounded(sizes).where(F.col("members") > CHUNK), "root"
    ).select("node", "root")
    ranked = _smallest(hubs)
    wanted = materialise(
        blocks.df.join(bounded(sizes), "root").join(ranked, "node", "left")
        .join(classes.df, F.col("node") == F.col("row"))
        .select("row", "n", F.col("best.i").alias("id"), F.col("best.r").alias("at"), F.col("best.t").alias("text_hash"), F.col("root").alias("block"), "members", F.coalesce("hub_rank", F.lit(HUBS + 1)).alias("hub_rank")),
        "wanted",
    )
    if row_col:
        found = texts.alias("t").join(bounded(wanted).alias("w"), F.col("t.row") == F.col("w.at"))
    else:
        found = texts.drop("row").withColumn("text_hash", F.xxhash64("text")).alias("t").join(
            bounded(wanted).alias("w"),
            (F.col("t.text_hash") == F.col("w.text_hash")) & F.col("t.id").eqNullSafe(F.col("w.id")),
        )
    found = found.select("w.row", "w.n", "w.block", "w.members", "w.hub_rank", "t.text")
    sets = materialise(
        found if row_col else found.dropDuplicates(["row"]),
        "sets",
        metrics={"largest": F.max("members")},
        codec="zstd",
    )
    release(docs.sparkSession, blocks.path, sizes.path, wanted.path)
    links = _linked(sets, size, part, whole)

    labelled = materialise(
        classes.df.join(bounded(links), F.col("row") == F.col("node"), "left").select(
            "class", "best", F.coalesce("root", "row").alias("label")
        ),
        "labelled-classes",
    )
    best = materialise(labelled.df.groupBy("label").agg(F.min("best").alias("best")), "best-rows")
    named = materialise(
        labelled.df.select("class", "label").join(best.df, "label").select("class", "best"),
        "class-components",
    )
    release(docs.sparkSession, links.path, classes.path, labelled.path, best.path)
    return rows, named.df


def _smallest(hubs: DataFrame) -> DataFrame:
    """The hubs of each block: rank 1 to ``HUBS`` by a hash, found without gathering a block."""
    picks = hubs.groupBy("root").agg(
        *[
            F.min_by("node", F.xxhash64("node", F.lit(k))).alias(f"h{k}")
            for k in range(HUBS)
        ]
    )
    return (
        picks.select(F.posexplode(F.array(*[f"h{k}" for k in range(HUBS)])).alias("k", "node"))
        .groupBy("node").agg((F.min("k") + 1).alias("hub_rank"))
    )


def drop_near_copies(
    docs: DataFrame,
    size: int = 5,
    part: int = 4,
    whole: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Of each component the row with the smallest id stays, columns unchanged.

    Of rows that share that id one stays; rows without words all stay. Rows are
    numbered and written once; only id, text and number go through Python.
    """
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("kept"))
    numbered = materialise(
        packed.withColumn("row", F.monotonically_increasing_id()), "numbered", codec="zstd"
    ).df
    texts = numbered.select(
        F.col("kept")[id_col].alias("id"), F.col("kept")[text_col].alias("text"), "row"
    )
    rows, named = _members(texts, size, part, whole, "id", "text", "row")
    copies = materialise(
        rows.where("n > 0").join(named, "class").where(F.col("best.r") != F.col("row")).select("row"),
        "copies",
    )
    return (
        numbered.join(bounded(copies), "row", "left_anti")
        .select(*[F.col("kept")[c].alias(c) for c in docs.columns])
    )
