"""Token ids as raw binary shards with a minimal perfect hash index.

A store is a folder of pairs of files:

``NNNNN-*.ids``
    ids of all texts of the shard end to end, little-endian unsigned; 16-bit if
    the vocabulary has at most 65,536 entries, else 32-bit.
``NNNNN-*.idx``
    eight little-endian 64-bit numbers (magic, version, texts, ids, levels, bytes
    of the hash, null keys, bytes of an id), then the hash (level sizes, bits), then per slot
    fingerprint (u32) and rank (u32), then per rank key (i64), occurrence (u32)
    and, for one rank more, the offset of its first id (u64).

Shards hold ascending ranges of keys; their list says where each range begins.
An occurrence counts the earlier texts of the same key in the shard.
A key's slot, fingerprint, rank and offsets take a constant number of reads.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from batchgate.llm.common import Table, materialise, mix, new_folder, open_input, open_output, release, settled
from batchgate.llm.perfect_hash import PerfectHash, fingerprints
from batchgate.llm.word_bpe import encoded, id_bytes

MAGIC, VERSION = 0x58444954, 1
HEAD = struct.Struct("<8q")
# Ids of about this many bytes make a shard; its index takes less than that in memory.
SHARD_BYTES = 64 << 20
_READ = 1 << 20


def key_hash(keys: np.ndarray, occurrence: np.ndarray, null: np.ndarray) -> np.ndarray:
    """One 64-bit value of each (key, occurrence); without repeats it is one to one."""
    spread = mix(occurrence.astype(np.uint64) * np.uint64(2) + null.astype(np.uint64))
    spread[(occurrence == 0) & ~null] = 0
    return keys.astype(np.int64).view(np.uint64) ^ spread


class _Keys:
    """Keys of a shard as they come, ascending with nulls last."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.nulls = 0

    def add(self, column: pa.Array) -> None:
        self.nulls += column.null_count
        self.parts.append(column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = np.concatenate([np.zeros(0, np.int64), *self.parts])
        null = np.arange(len(keys)) >= len(keys) - self.nulls
        new = np.r_[True, (keys[1:] != keys[:-1]) | (null[1:] != null[:-1])][: len(keys)]
        start = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
        return keys, np.arange(len(keys)) - start, null


def _index(keys: _Keys, bounds: np.ndarray, width: int) -> bytes:
    key, occurrence, null = keys.all()
    hashed = key_hash(key, occurrence, null)
    mph = PerfectHash.build(hashed)
    slot = mph.slots(hashed)
    marks, rank = np.empty(len(key), "<u4"), np.empty(len(key), "<u4")
    marks[slot], rank[slot] = fingerprints(hashed), np.arange(len(key))
    head = (MAGIC, VERSION, len(key), int(bounds[-1]), len(mph.sizes), len(mph.bits), keys.nulls, width)
    parts = (mph.sizes, mph.bits, marks, rank, key.astype("<i8"), occurrence.astype("<u4"), bounds.astype("<u8"))
    return HEAD.pack(*head) + b"".join(x.tobytes() for x in parts)


class Shard:
    """An opened shard; the payload is read in ranges."""

    def __init__(self, path: str):
        with open_input(f"{path}.idx") as f:
            raw = f.read()
        magic, version, n, _, levels, size, nulls, self.width = HEAD.unpack_from(raw)
        if (magic, version) != (MAGIC, VERSION):
            raise ValueError(f"{path} is no token index")
        at = HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(raw, kind, count, at)
            at += found.nbytes
            return found

        self.hash = PerfectHash(take("<i8", levels), take("u1", size))
        self.marks, self.rank = take("<u4", n), take("<u4", n).astype(np.int64)
        self.keys, self.occurrences = take("<i8", n), take("<u4", n)
        self.bounds = take("<u8", n + 1).astype(np.int64)
        self.null = np.arange(n) >= n - nulls
        self.payload = open_input(f"{path}.ids")

    def find(self, keys, occurrences=None, null=None) -> np.ndarray:
        """Rank of each key in the shard, -1 if its fingerprint is not the one stored."""
        keys = np.asarray(keys, np.int64)
        occurrences = np.zeros(len(keys), np.int64) if occurrences is None else occurrences
        null = np.zeros(len(keys), bool) if null is None else null
        hashed = key_hash(keys, np.asarray(occurrences), np.asarray(null))
        slot = self.hash.slots(hashed)
        known = slot >= 0
        known[known] = self.marks[slot[known]] == fingerprints(hashed[known])
        return np.where(known, self.rank[np.where(known, slot, 0)], -1) if len(self.rank) else slot

    def read(self, first: int, last: int | None = None) -> np.ndarray:
        """The ids of the texts ranked ``first`` to ``last`` (exclusive), or of one."""
        a, b = self.bounds[first], self.bounds[first + 1 if last is None else last]
        self.payload.seek(self.width * int(a))
        raw = self.payload.read(self.width * int(b - a))
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4", copy=False)


def write_store(
    docs: DataFrame,
    tokenizer: str,
    shard_bytes: int = SHARD_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Table:
    """Encode and write all texts; one row per shard: path, first_key, texts, ids, base.

    Texts lie in ascending order of id, null ids last, repeated ids in order of a
    hash of their text; ``base`` is the number of ids in earlier shards. A null
    text is the end id alone. An empty table gives no shard. A task writes under a
    name of its own and only names of tasks that ended well are listed, so a
    repeated task leaves an unlisted file at most.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = id_bytes(tokenizer)
        for batch in batches:
            for first, last, ids, at in encoded(batch.column(2), tokenizer):
                raw = pa.py_buffer(ids.astype(f"<u{width}", copy=False))
                packed = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), last - first, [None, pa.py_buffer(at * width), raw]
                )
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(first, last - first) for i in (0, 1)], packed.cast(pa.binary())],
                    names=["key", "mark", "ids"],
                )

    # Ids are smaller than texts, so they are what is moved.
    coded = materialise(
        docs.select(
            F.col(id_col).cast("long").alias("_key"), F.xxhash64(text_col).alias("_mark"), F.col(text_col).alias("_text")
        ).mapInArrow(settled(encode), "key long, mark long, ids binary"),
        "coded",
        F.octet_length("ids"),
        codec="zstd",
    )
    # As many tasks as shuffles have at least, more when shards would grow beyond their size.
    tasks = max(
        min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-coded.bytes // (1 << 20))),
        -(-coded.bytes // shard_bytes),
        1,
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, keys, bounds, total, out, path = TaskContext.get().partitionId(), _Keys(), [np.zeros(1, np.int64)], 0, None, None
        width = id_bytes(tokenizer)
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                path = f"{folder}/{part:05d}-{uuid.uuid4().hex}"
                out = open_output(f"{path}.ids")
            keys.add(batch.column(0))
            packed = batch.column(1).cast(pa.large_binary())
            _, offsets, data = packed.buffers()
            at = np.frombuffer(offsets, np.int64)[packed.offset : packed.offset + len(packed) + 1]
            out.write(data[int(at[0]) : int(at[-1])])
            bounds.append((at[1:] - at[0]) // width + total)
            total += int(at[-1] - at[0]) // width
        if out is None:
            return
        out.close()
        with open_output(f"{path}.idx") as f:
            f.write(_index(keys, np.concatenate(bounds), width))
        key, _, null = keys.all()
        yield pa.RecordBatch.from_pydict(
            {
                "part": [part],
                "path": [path],
                "first_key": pa.array([None if null[0] else int(key[0])], pa.int64()),
                "texts": [len(key)],
                "ids": [total],
            }
        )

    order = [F.col("key").isNull(), F.col("key"), F.col("mark")]
    written = materialise(
        coded.df.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("key", "ids")
        .mapInArrow(write, "part long, path string, first_key long, texts long, ids long"),
        "token-shards",
    )
    release(spark, coded.path)
    # One row per shard.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = written.df.withColumn("base", F.coalesce(F.sum("ids").over(earlier), F.lit(0)))
    return materialise(based, "token-store")


def read_store(spark: SparkSession, store: Table) -> DataFrame:
    """Every text of the store: _key, start, n_tokens, ids_crc32, occurrence.

    Each task opens shards, looks their keys up in the index, and reads the
    payload in order; a key whose slot does not lead back to it is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["path"])
                rank = shard.find(shard.keys, shard.occurrences, shard.null)
                if not np.array_equal(rank, np.arange(len(shard.keys))):
                    raise ValueError(f"{row['path']}: index and keys differ")
                b = shard.bounds
                at = 0
                while at < len(rank):
                    to = max(at + 1, int(np.searchsorted(b, b[at] + _READ // 4, "right")) - 1)
                    raw = memoryview(shard.read(at, to)).cast("B")
                    cut = ((b[at : to + 1] - b[at]) * 4).tolist()
                    crc = [zlib.crc32(raw[x:y]) for x, y in zip(cut, cut[1:], strict=False)]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "_key": pa.array(shard.keys[at:to], pa.int64(), mask=shard.null[at:to]),
                            "start": pa.array(b[at:to] + row["base"]),
                            "n_tokens": pa.array(np.diff(b[at : to + 1])),
                            "ids_crc32": pa.array(crc, pa.int64()),
                            "occurrence": pa.array(shard.occurrences[at:to].astype(np.int64)),
                        }
                    )
                    at = to

    # One shard or more for a task; shards are of even size.
    return (
        store.df.repartition(max(store.rows, 1), "path")
        .mapInArrow(read, "_key long, start long, n_tokens long, ids_crc32 long, occurrence long")
    )


def lookup(store: Table, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Keyed access: the ids of every wanted id that the store holds, as an array.

    Ids that are null or not in the store give no row; a repeated id of the store
    gives its first occurrence. Wanted ids meet the shard whose range holds them.
    """
    listed = store.df.where(F.col("first_key").isNotNull()).select("path", "first_key").orderBy("first_key").toPandas()
    firsts, paths = listed["first_key"].to_numpy(np.int64), listed["path"].tolist()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            at = np.searchsorted(firsts, keys, "left")
            # A repeated id may begin in the shard before the one it is first of.
            for step in (-1, 0):
                ok = (at + step >= 0) & (at + step < len(firsts))
                ok[ok] &= firsts[at[ok] + step] <= keys[ok]
                yield pa.RecordBatch.from_pydict(
                    {"key": pa.array(keys[ok]), "shard": pa.array((at + step)[ok].astype(np.int32))}
                )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[int, Shard | None] = (-1, None)
        for batch in batches:
            keys, shards = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for s in np.unique(shards):
                if opened[0] != s:
                    opened = (s, Shard(paths[s]))
                own = keys[shards == s]
                rank = opened[1].find(own)
                found = [(k, r) for k, r in zip(own.tolist(), rank.tolist(), strict=True) if r >= 0 and opened[1].keys[r] == k]
                yield pa.RecordBatch.from_pydict(
                    {
                        "_key": pa.array([k for k, _ in found], pa.int64()),
                        "shard": pa.array([int(s)] * len(found), pa.int32()),
                        "ids": pa.array([opened[1].read(r).tolist() for _, r in found], pa.list_(pa.int64())),
                    }
                )

    keys = wanted.select(F.col(id_col).cast("long").alias("key")).where("key IS NOT NULL").distinct()
    return (
        keys.mapInArrow(route, "key long, shard int")
        .repartition("shard").sortWithinPartitions("shard", "key")
        .mapInArrow(fetch, "_key long, shard int, ids array<long>")
        .groupBy(F.col("_key").alias(id_col)).agg(F.min_by("ids", "shard").alias("ids"))
    )
