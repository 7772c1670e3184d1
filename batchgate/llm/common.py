"""Helpers shared by the operators: checked lookups, shared files, word hashes."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate.session import Table, kept_tables, materialise, release, scratch_root

__all__ = [
    "Table",
    "bounded",
    "connected",
    "give_back",
    "kept_tables",
    "materialise",
    "mix",
    "new_folder",
    "open_input",
    "open_output",
    "release",
    "settled",
    "table",
    "text_runs",
    "word_hashes",
]

# A looked-up table is broadcast up to this size, as observed while it was written.
BROADCAST_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(found: Table, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The table with a broadcast hint if its observed size allows; else joins shuffle."""
    return F.broadcast(found.df) if found.bytes <= limit else found.df


# --- files in the shared folder ---------------------------------------------


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def new_folder(spark: SparkSession, name: str) -> str:
    """The URI of a fresh folder that driver and executors share."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def open_output(uri: str):
    files, path = _filesystem(uri)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    return files.open_output_stream(path)


def open_input(uri: str):
    files, path = _filesystem(uri)
    return files.open_input_file(path)


# --- memory of workers --------------------------------------------------------


def give_back() -> None:
    """Return to the system what this process has freed but its allocators keep."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def settled(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``, which gives freed memory back when its task ends.

    Workers outlive tasks; what allocators keep would add to the next stage's memory.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


# --- words of whole Arrow columns -------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_BYTE_VALUES = np.random.default_rng(20240215).integers(1, 1 << 63, 256, np.uint64)

SPACE = bytes([0x20, *range(0x09, 0x0E)])
# Byte -> lower-cased byte, or 0 where words end.
SPACE_SPLIT = np.arange(256, dtype=np.uint8)
SPACE_SPLIT[0x41:0x5B] += 0x20
SPACE_SPLIT[0] = 0xFF  # a NUL belongs to its word; no UTF-8 byte is 0xFF
SPACE_SPLIT[list(SPACE)] = 0


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grown(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, 1 << 20), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def _hash_run(data: np.ndarray, bounds: np.ndarray, split: np.ndarray):
    n = len(data)
    code = split[data]
    inside = code != 0
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    power, inverse = _grown(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[code] * power[:n], out=total[1:])
    h = (total[last] - total[first]) * inverse[first]
    return mix(h + (last - first).astype(np.uint64) * np.uint64(_BASE)), first


def word_hashes(
    data: np.ndarray, bounds: np.ndarray, split: np.ndarray = SPACE_SPLIT, step: int = 1 << 20
) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words in UTF-8 ``data``, and where each text's words begin.

    ``bounds`` are the texts' byte offsets; ``split`` maps bytes to what is hashed,
    0 between words. Equal words have equal hashes wherever they stand. A long
    text is hashed in steps that end between words.
    """
    if len(data) <= 2 * step:
        hashes, first = _hash_run(data, bounds, split)
        return hashes, np.searchsorted(first, bounds)
    gaps = np.flatnonzero(split[data] == 0)
    cuts, at = [0], 0
    while len(data) - at > step:
        k = np.searchsorted(gaps, at + step)
        at = int(gaps[k]) + 1 if k < len(gaps) else len(data)
        cuts.append(at)
    if cuts[-1] < len(data):
        cuts.append(len(data))
    parts, firsts = [], []
    for a, b in zip(cuts, cuts[1:], strict=False):
        inner = bounds[(bounds > a) & (bounds < b)] - a
        hashes, first = _hash_run(data[a:b], np.r_[0, inner, b - a], split)
        parts.append(hashes)
        firsts.append(first + a)
    return np.concatenate(parts), np.searchsorted(np.concatenate(firsts), bounds)


def text_runs(
    column: pa.Array | pa.ChunkedArray, most: int = 1 << 20
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive texts as ``(first, last, bytes, bounds)``, about ``most`` bytes each.

    Null counts as empty. Only a text longer than ``most`` makes a longer run.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    texts = column.fill_null("").cast(pa.large_string()) if len(column) else column
    if not len(column):
        return
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield at, to, raw[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        at = to


# --- connected components ------------------------------------------------------


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> Table:
    """``(node, root)`` for every node of the edges; root is the component's smallest node.

    Alternates two steps until nothing moves: each node hands its larger
    neighbours, then its smaller ones, to the smallest it knows. Every step is a
    minimum per node joined back to the edges, so a node with any number of
    edges is spread by partial aggregation and split joins.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = materialise(pairs.where("u != v").distinct(), "edges")
    mark = None
    while True:
        both = now.df.union(now.df.select(F.col("v"), F.col("u")))
        low = materialise(
            both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "lowest"
        )
        large = materialise(
            both.where("v > u").join(bounded(low), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "large",
        )
        least = materialise(large.df.groupBy("u").agg(F.min("v").alias("m")), "least")
        nxt = materialise(
            large.df.join(bounded(least), "u").where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.df.select("u", F.col("m").alias("v")))
            .distinct(),
            "edges",
            metrics={"mark": F.bit_xor(F.xxhash64("u", "v"))},
        )
        release(spark, now.path, low.path, large.path, least.path)
        if (nxt.rows, nxt.metrics["mark"]) == mark:
            break
        mark, now = (nxt.rows, nxt.metrics["mark"]), nxt
    roots = nxt.df.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return materialise(
        nxt.df.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots), "components"
    )
