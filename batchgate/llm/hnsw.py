"""Approximate nearest neighbours: a navigable small-world graph per shard.

Vectors are dealt to shards by a hash. A shard's graph has levels: every vector
is on level 0, about one in ``BRANCH`` of a level's vectors on the next. On each
level a vector keeps neighbours that are closer to it than to one another, and
is kept by them in turn; neighbours are rows of one flat integer array per level.
Queries go through each shard from the top level down, then widen on level 0;
the best of all shards are merged by score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from batchgate.llm.common import materialise, mix

# Vectors of a shard. Its graph is built and searched in one task.
SHARD_ROWS = 8192
NEIGHBOURS = 24  # twice as many on level 0
CANDIDATES = 96  # nearest ones that neighbours are chosen from
BRANCH = 24
WIDTH = 96  # how many of the best the search keeps on level 0
# Queries that go through a shard together.
QUERY_BLOCK = 1024
_BLOCK = 512


@dataclass
class Graph:
    vectors: np.ndarray  # float32, one row per vector
    levels: list[tuple[np.ndarray, np.ndarray]]  # (members, neighbours), -1 for none

    @property
    def entry(self) -> int:
        return int(self.levels[-1][0][0])


def _choose(vectors: np.ndarray, order: np.ndarray, near: np.ndarray, keep: int) -> np.ndarray:
    """Of each row's candidates, nearest first, those nearer to it than to one chosen."""
    n, many = order.shape
    chosen = np.full((n, keep), -1, np.int32)
    count = np.zeros(n, np.int64)
    rows = np.arange(n)
    for j in range(many):
        here = order[:, j]
        own = vectors[here]
        ok = (here >= 0) & (count < keep)
        for k in range(int(count.max()) if n else 0):
            other = chosen[:, k]
            has = other >= 0
            ok &= ~has | (np.einsum("ij,ij->i", own, vectors[other]) < near[:, j])
        chosen[rows[ok], count[ok]] = here[ok]
        count[ok] += 1
    return chosen


def _level(vectors: np.ndarray, members: np.ndarray, keep: int) -> np.ndarray:
    """Neighbour rows of a level: chosen ones, and those that chose the vector."""
    n = len(members)
    many = min(CANDIDATES, n - 1)
    own = vectors[members]
    chosen = np.full((n, keep // 2), -1, np.int32)
    for at in range(0, n if many > 0 else 0, _BLOCK):
        score = own[at : at + _BLOCK] @ own.T
        rows = np.arange(len(score))
        score[rows, at + rows] = -np.inf
        best = np.argpartition(-score, many - 1, axis=1)[:, :many]
        value = np.take_along_axis(score, best, 1)
        rank = np.argsort(-value, axis=1, kind="stable")
        best, value = np.take_along_axis(best, rank, 1), np.take_along_axis(value, rank, 1)
        chosen[at : at + _BLOCK] = _choose(own, best.astype(np.int32), value, keep // 2)
    # Links go both ways; a vector chosen by many keeps the nearest of them.
    a = np.repeat(np.arange(n), keep // 2)
    b = chosen.ravel()
    a, b = a[b >= 0], b[b >= 0]
    both = np.unique(np.r_[a * n + b, b * n + a])
    a, b = both // n, both % n
    value = np.einsum("ij,ij->i", own[a], own[b])
    order = np.lexsort((b, -value, a))
    a, b = a[order], b[order]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    flat = np.full((n, keep), -1, np.int32)
    some = place < keep
    flat[a[some], place[some]] = b[some]
    return flat


def build(keys: np.ndarray, vectors: np.ndarray) -> Graph:
    """The graph of a shard; a vector's levels follow from its key alone."""
    draw = mix(keys.astype(np.int64).view(np.uint64) + np.uint64(1))
    unit = (draw >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    top = np.floor(-np.log(np.maximum(unit, 1e-18)) / np.log(BRANCH)).astype(np.int64)
    levels = []
    for level in range(int(top.max()) + 1):
        members = np.flatnonzero(top >= level)
        flat = _level(vectors, members, NEIGHBOURS * (2 if level == 0 else 1))
        levels.append((members, np.where(flat >= 0, members[flat], -1).astype(np.int32)))
    return Graph(vectors, levels)


def search(graph: Graph, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of about the ``width`` best vectors for each query, best first."""
    vectors = graph.vectors
    n, q = len(vectors), len(queries)
    at = np.full(q, graph.entry)
    value = np.einsum("ij,ij->i", queries, vectors[at])
    for members, flat in reversed(graph.levels[1:]):
        row = np.full(n, -1)
        row[members] = np.arange(len(members))
        moving = np.arange(q)
        while len(moving):
            near = flat[row[at[moving]]]
            score = np.einsum("ijk,ik->ij", vectors[near], queries[moving])
            score[near < 0] = -np.inf
            best = score.argmax(1)
            found = score[np.arange(len(moving)), best]
            better = found > value[moving]
            at[moving[better]] = near[better, best[better]]
            value[moving[better]] = found[better]
            moving = moving[better]
    flat = graph.levels[0][1]
    width = min(width, n)
    pool = np.full((q, width), -1, np.int32)
    score = np.full((q, width), -np.inf, np.float32)
    done = np.ones((q, width), bool)
    pool[:, 0], score[:, 0], done[:, 0] = at, value, False
    seen = np.zeros((q, n), bool)
    seen[np.arange(q), at] = True
    active = np.arange(q)
    while len(active):
        waiting = np.where(done[active], -np.inf, score[active])
        best = waiting.argmax(1)
        ok = waiting[np.arange(len(active)), best] > -np.inf
        active, best = active[ok], best[ok]
        if not len(active):
            break
        done[active, best] = True
        near = flat[pool[active, best]]
        fresh = (near >= 0) & ~seen[active[:, None], np.maximum(near, 0)]
        who, slot = np.nonzero(fresh)
        seen[active[who], near[who, slot]] = True
        found = np.full(near.shape, -np.inf, np.float32)
        found[who, slot] = np.einsum("ij,ij->i", vectors[near[who, slot]], queries[active[who]])
        all_score = np.concatenate([score[active], found], 1)
        all_pool = np.concatenate([pool[active], near], 1)
        all_done = np.concatenate([done[active], ~fresh], 1)
        keep = np.argpartition(-all_score, width - 1, axis=1)[:, :width]
        score[active] = np.take_along_axis(all_score, keep, 1)
        pool[active] = np.take_along_axis(all_pool, keep, 1)
        done[active] = np.take_along_axis(all_done, keep, 1)
    order = np.argsort(-score, axis=1, kind="stable")
    return np.take_along_axis(pool, order, 1), np.take_along_axis(score, order, 1)


def nearest(
    table: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    width: int = WIDTH,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The ``k`` vectors of ``table`` with the largest inner product with each query.

    Returns query_id, rank (from 1), the id, score (double precision on the given
    vectors); ties go to the smaller id, and a query's own id is no candidate.
    Vectors that are null, zero, or hold a null or a number that is not finite
    take no part, nor do rows without id. Inner products need one length: it is that
    of most vectors of ``table`` (the shorter of equals), and vectors of others,
    queries included, take no part either. Other columns may have any names.
    Of equal vectors the k + 1 smallest ids are indexed, as ties allow no other.
    With fewer candidates all are returned; an empty table gives no row.
    """
    valid = _valid(table, id_col, vector_col)
    most = valid.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    length = F.size("vector") == (most["d"] if most else 0)
    valid = valid.where(length)
    wide = valid.schema["vector"].dataType.elementType.simpleString() == "double"
    kind = "<f8" if wide else "<f4"
    # Of equal vectors the k + 1 smallest ids, the first of which stands for them.
    equal = Window.partitionBy("vector").orderBy("id")
    classes = materialise(
        valid.withColumn("n", F.row_number().over(equal)).where(F.col("n") <= k + 1)
        .groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select(F.col("ids")[0].alias("key"), "ids", "vector"),
        "distinct-vectors",
    )
    shards = max(1, -(-classes.rows // shard_rows))
    index = materialise(
        classes.df.select(F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"), "key", "vector")
        .repartition(shards, "shard").sortWithinPartitions("shard", "key")
        .mapInArrow(_indexed(kind), INDEX_SCHEMA),
        "graphs",
    ).df
    wanted = _valid(queries, id_col, vector_col).where(length)
    blocks = max(1, -(-wanted.count() // QUERY_BLOCK))
    asked = materialise(
        wanted.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), "id", "vector")
        .repartition(blocks, "block").sortWithinPartitions("block", "id")
        .mapInArrow(_packed(kind), "block int, ids binary, queries binary"),
        "query-blocks",
    ).df
    units = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = units.join(index.hint("shuffle_merge"), "shard").mapInArrow(
        _searched(kind, k + 1, width), "query_id long, key long, score double"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec")
    return (
        found.join(classes.df.select("key", "ids"), "key")
        .select("query_id", "score", F.explode("ids").alias("vec"))
        .where("vec != query_id")
        .distinct()
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec").alias(id_col), "score")
    )


def _valid(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part."""
    return table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where(
        F.col("id").isNotNull()
        & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )


INDEX_SCHEMA = (
    "shard int, keys binary, vectors binary, "
    "levels array<struct<members: binary, neighbours: binary>>"
)


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1)


def _parts(batches: Iterator[pa.RecordBatch], kind: str):
    """(part, ids, matrix) of each value of the first column; rows arrive sorted by it."""
    own: int | None = None
    ids: list[np.ndarray] = []
    rows: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        part, key, matrix = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), kind)
        cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if own is not None and part[a] != own:
                yield own, np.concatenate(ids), np.concatenate(rows)
                ids, rows = [], []
            own = int(part[a])
            ids.append(key[a:b])
            rows.append(matrix[a:b])
    if own is not None:
        yield own, np.concatenate(ids), np.concatenate(rows)


def _indexed(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, keys, vectors in _parts(batches, kind):
            graph = build(keys, vectors.astype(np.float32, copy=False))
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "keys": pa.array([keys.astype("<i8").tobytes()], pa.binary()),
                    "vectors": pa.array([vectors.tobytes()], pa.binary()),
                    "levels": pa.array(
                        [[{"members": m.astype("<i4").tobytes(), "neighbours": f.astype("<i4").tobytes()} for m, f in graph.levels]],
                        pa.list_(pa.struct([("members", pa.binary()), ("neighbours", pa.binary())])),
                    ),
                }
            )

    return run


def _packed(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, vectors in _parts(batches, kind):
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([block], pa.int32()),
                    "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                    "queries": pa.array([vectors.tobytes()], pa.binary()),
                }
            )

    return run


def _searched(kind: str, k: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                keys, ids = np.frombuffer(row["keys"], "<i8"), np.frombuffer(row["ids"], "<i8")
                vectors = np.frombuffer(row["vectors"], kind).reshape(len(keys), -1)
                levels = []
                for level in row["levels"]:
                    members = np.frombuffer(level["members"], "<i4")
                    flat = np.frombuffer(level["neighbours"], "<i4").reshape(len(members), -1)
                    levels.append((members, flat))
                graph = Graph(vectors.astype(np.float32, copy=False), levels)
                queries = np.frombuffer(row["queries"], kind).reshape(len(ids), -1)
                pool, _ = search(graph, queries.astype(np.float32, copy=False), width)
                asked, at = np.nonzero(pool >= 0)
                hit = pool[asked, at]
                # Double precision on the given vectors decides which are kept.
                score = np.einsum("ij,ij->i", vectors[hit].astype(np.float64), queries[asked].astype(np.float64))
                order = np.lexsort((keys[hit], -score, asked))
                asked, hit, score = asked[order], hit[order], score[order]
                top = np.arange(len(asked)) - np.searchsorted(asked, asked) < k
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": pa.array(ids[asked[top]]),
                        "key": pa.array(keys[hit[top]]),
                        "score": pa.array(score[top]),
                    }
                )

    return run
