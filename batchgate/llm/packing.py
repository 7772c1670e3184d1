"""Best-fit packing planned on the histogram of lengths.

Texts are cut into pieces of at most ``capacity`` ids. Best-fit decreasing then
runs over the counts per length, not over pieces: equal pieces go into equal
sequences together, so the plan is a list of slot ranges whose size depends on
``capacity`` alone. Pieces take the slots of their length by rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from batchgate.llm.common import bounded, materialise, settled
from batchgate.llm.word_bpe import encoded

CAPACITY = 4096


def cut(docs: DataFrame, tokenizer: str, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """One row per piece, with its rank among the pieces of its length in the same task."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for first, last, ids, bounds in encoded(batch.column(1), tokenizer):
                sizes = np.diff(bounds)
                count = -(-sizes // capacity)
                doc = np.repeat(np.arange(last - first), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(sizes[doc] - start, capacity)
                raw = memoryview(ids.tobytes())
                begin = (bounds[doc] + start) * 4
                crc = [
                    zlib.crc32(raw[a : a + 4 * n])
                    for a, n in zip(begin.tolist(), length.tolist(), strict=True)
                ]
                order = np.argsort(length, kind="stable")
                found, at, many = np.unique(length[order], return_index=True, return_counts=True)
                rank = np.empty(len(length), np.int64)
                rank[order] = np.arange(len(length)) - np.repeat(at, many) + seen[length[order]]
                seen[found] += many
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first).take(pa.array(doc)),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.array(np.full(len(doc), block), pa.int32()),
                        pa.array(rank, pa.int64()),
                    ],
                    names=["_id", "piece", "start", "length", "ids_crc32", "block", "rank"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string")).mapInArrow(
        settled(pieces),
        f"_id {kind}, piece int, start long, length long, ids_crc32 long, block int, rank long",
    )


def plan(histogram: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Best-fit decreasing over ``{length: count}`` as ranges of slots.

    Range i holds the pieces of ``length[i]`` ranked from ``rank[i]`` on (up to the
    next range): ``each[i]`` go into every sequence from ``sequence[i]`` on, one
    after another from ``offset[i]``. A piece goes where least room remains, so
    a sequence that takes one takes as many equal ones as fit.
    """
    # Room that remains -> groups (first sequence, how many) of sequences alike.
    room: dict[int, list[tuple[int, int]]] = {}
    ranges: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        placed: list[tuple[int, int, int]] = []  # what remains, with the groups, afterwards

        def place(first: int, many: int, free: int, each: int, offset: int):
            nonlocal left, rank
            if many and each:
                ranges.append((length, rank, first, each, offset))
                left -= many * each
                rank += many * each
            if many:
                placed.append((free - each * length, first, many))

        for free in sorted(r for r in room if r >= length):
            if not left:
                break
            fits = free // length
            for first, many in room.pop(free):
                full = min(many, left // fits)
                place(first, full, free, fits, capacity - free)
                if full < many:
                    rest = left  # fewer than fit into one sequence
                    place(first + full, 1, free, rest, capacity - free)
                    place(first + full + 1, many - full - 1, free, 0, capacity - free)
        if left:
            fits = capacity // length
            full, rest = divmod(left, fits)
            place(sequences, full, capacity, fits, 0)
            place(sequences + full, 1 if rest else 0, capacity, rest, 0)
            sequences += full + (1 if rest else 0)
        for free, first, many in placed:
            room.setdefault(free, []).append((first, many))
    ranges.sort(key=lambda r: (r[0], r[1]))
    columns = np.array(ranges, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "sequence", "each", "offset"), columns, strict=True))


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A text is its ids and the end id; null is empty and has the end id alone.
    Texts longer than ``capacity`` are cut into full pieces and a last shorter one;
    no other is cut. Repeated rows and null ids are packed like any others. An
    empty table gives no piece. Sequences are numbered from 0 and have no gaps.
    """
    spark = docs.sparkSession
    pieces = materialise(cut(docs, tokenizer, capacity, id_col, text_col), "pieces").df
    counts = pieces.groupBy("block", "length").count()
    earlier = Window.partitionBy("length").orderBy("block")
    blocks = materialise(
        counts.withColumn("before", F.sum("count").over(earlier) - F.col("count")), "blocks"
    )
    # At most `capacity` rows, whatever the input.
    histogram = {r["length"]: r["n"] for r in blocks.df.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(plan(histogram, capacity))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = slots.value
        begin = np.searchsorted(p["length"], np.arange(capacity + 2))
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.empty(len(length), np.int64)
            for n in np.unique(length):
                own = p["rank"][begin[n] : begin[n + 1]]
                mine = length == n
                at[mine] = begin[n] + np.searchsorted(own, rank[mine], "right") - 1
            within = rank - p["rank"][at]
            each = p["each"][at]
            out = {name: batch.column(name) for name in ("_id", "piece", "start", "length", "ids_crc32")}
            out["sequence_id"] = pa.array(p["sequence"][at] + within // each)
            out["offset"] = pa.array(p["offset"][at] + within % each * length)
            yield pa.RecordBatch.from_pydict(out)

    kind = docs.schema[id_col].dataType.simpleString()
    ranked = pieces.join(
        bounded(blocks).select("block", "length", "before"), ["block", "length"]
    ).withColumn("rank", F.col("before") + F.col("rank"))
    return ranked.mapInArrow(
        take,
        f"_id {kind}, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    ).withColumnRenamed("_id", id_col)
