"""Vector codes: product codebooks on integers, nearest entries by a Walsh-Hadamard transform.

Components become integers, vectors are cut into parts, and every part position
has a codebook. A part and its entries are padded with zeros to a power of two and
transformed by sums and differences alone, which multiplies squared distances
by the padded length. Squared differences are added up in order of sequency (sign
changes, so the coarse shape of a part comes first); an entry whose sum so far
exceeds the whole distance of a likely one is out. All figures are integers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import bounded, materialise

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
# Vectors that are compared with all entries at a time.
BLOCK = 4096
# Sums leave a task in pieces of so many bits if they do not fit into a long.
_LIMB = 48


def hadamard(x: np.ndarray) -> np.ndarray:
    """The transform of rows padded to a power of two, coefficients by rising sequency."""
    n = 1 << max(x.shape[1] - 1, 0).bit_length()
    out = np.zeros((len(x), n), x.dtype)
    out[:, : x.shape[1]] = x
    half = 1
    while half < n:
        pairs = out.reshape(len(x), -1, 2, half)
        a, b = pairs[:, :, 0, :].copy(), pairs[:, :, 1, :].copy()
        pairs[:, :, 0, :], pairs[:, :, 1, :] = a + b, a - b
        half *= 2
    return out[:, sequency(n)]


def sequency(n: int) -> np.ndarray:
    """Natural positions of the ``n`` coefficients, by the sign changes of their functions."""
    i = np.arange(n)
    signs = np.bitwise_count(i[:, None] & i[None, :]) & 1
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(1), kind="stable")


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest entry (the lowest of equals) and its squared distance."""
    index = np.empty(len(parts), np.int64)
    distance = np.empty(len(parts), parts.dtype)
    e = hadamard(entries)
    for at in range(0, len(parts), BLOCK):
        x = hadamard(parts[at : at + BLOCK])
        first = (x[:, :1] - e[None, :, 0]) ** 2
        likely = e[first.argmin(1)]
        limit = ((x - likely) ** 2).sum(1)
        rows, cols = np.nonzero(first <= limit[:, None])
        so_far = first[rows, cols]
        for k in range(1, x.shape[1]):
            so_far = so_far + (x[rows, k] - e[cols, k]) ** 2
            left = so_far <= limit[rows]
            rows, cols, so_far = rows[left], cols[left], so_far[left]
        # The likely entry is always left, so every row has one; rows and entries ascend.
        starts = np.searchsorted(rows, np.arange(len(x)))
        best = np.minimum.reduceat(so_far, starts)
        hit = np.flatnonzero(so_far == best[rows])
        index[at : at + len(x)] = cols[hit[np.searchsorted(rows[hit], np.arange(len(x)))]]
        distance[at : at + len(x)] = best // x.shape[1]
    return index, distance


def _exact(value: float, scale: int) -> int:
    top, bottom = value.as_integer_ratio()
    return top * scale // bottom


def _integers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each vector, padded with zeros; Python integers where 64 bits may not do."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    at = np.repeat(np.arange(len(column)) * width - np.cumsum(lengths) + lengths, lengths)
    small = not len(values) or float(np.abs(values).max()) * scale < 2 ** 24
    flat = np.floor(values * scale).astype(np.int64) if small else np.array([_exact(v, scale) for v in values.tolist()], object)
    out = np.zeros(len(column) * width, flat.dtype)
    out[at + np.arange(len(values))] = flat
    return out.reshape(len(column), width)


class Codebooks:
    """Entries per part position."""

    def __init__(self, books: list[np.ndarray]):
        self.books = books

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry per part, and the vector's squared distances summed."""
        step = self.books[0].shape[1]
        codes, error = np.empty((len(vectors), len(self.books)), np.int64), 0
        for p, entries in enumerate(self.books):
            own = vectors[:, p * step : (p + 1) * step]
            large = own.dtype == object or entries.dtype == object
            # Squares of transformed differences have to fit into 63 bits.
            if not large and own.size:
                span = 2 * int(max(np.abs(own).max(), np.abs(entries).max()))
                large = (span * (1 << max(step - 1, 0).bit_length())) ** 2 * max(step, 1) >= 1 << 62
            kind = object if large else np.int64
            codes[:, p], found = nearest(own.astype(kind), entries.astype(kind))
            error = error + found
        return codes, error

    def text(self) -> str:
        return ",".join(str(x) for book in self.books for x in book.reshape(-1).tolist())


def _limbs(value: int) -> list[int]:
    out = []
    while not -(1 << 62) <= value < 1 << 62:
        out.append(value & ((1 << _LIMB) - 1))
        value >>= _LIMB
    return [*out, value]


def _moved(vectors: DataFrame, width: int, scale: int, codebooks: Codebooks) -> Codebooks:
    """Every entry as the floored mean of its parts; unused entries stay.

    Each task sends its sums per entry and component. What reaches the driver is as
    large as the codebooks.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(codebooks)
    many, step = len(codebooks.books[0]), codebooks.books[0].shape[1]
    parts = len(codebooks.books)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, many), np.int64)
        sums = np.zeros((parts, many, step), object)
        for batch in batches:
            x = _integers(batch.column(0), width, scale)
            codes, _ = shared.value.assign(x)
            for p in range(parts):
                counts[p] += np.bincount(codes[:, p], minlength=many)
                own = np.zeros((many, step), x.dtype)
                np.add.at(own, codes[:, p], x[:, p * step : (p + 1) * step])
                sums[p] += own
        rows = [
            (p, k, at, limb, piece)
            for p, k in zip(*np.nonzero(counts), strict=True)
            for at, total in enumerate([int(counts[p, k]), *sums[p, k].tolist()])
            for limb, piece in enumerate(_limbs(int(total)))
        ]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(v) for v in c], pa.int64()) for c in columns],
            names=["part", "entry", "at", "limb", "piece"],
        )

    total = (
        vectors.select("vector")
        .mapInArrow(add, "part long, entry long, at long, limb long, piece long")
        .groupBy("part", "entry", "at", "limb")
        .agg(F.sum(F.col("piece").cast("decimal(38,0)")).alias("piece"))
        .collect()
    )
    sums: dict[tuple[int, int], dict[int, int]] = {}
    for r in total:
        own = sums.setdefault((r["part"], r["entry"]), {})
        own[r["at"]] = own.get(r["at"], 0) + (int(r["piece"]) << (_LIMB * r["limb"]))
    books = [b.astype(object) for b in codebooks.books]
    for (p, k), own in sums.items():
        books[p][k] = [own[1 + i] // own[0] for i in range(step)]
    return Codebooks([_narrow(b) for b in books])


def _narrow(book: np.ndarray) -> np.ndarray:
    fits = all(abs(int(x)) < 1 << 62 for x in book.reshape(-1))
    return book.astype(np.int64 if fits else object)


def encode(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Per kept row: id, ``code``, ``error``, ``label_error``, ``codebooks_sha256``.

    Rows whose vector is null or holds null or non-finite components are dropped.
    Codebooks start as the parts of the ``entries`` smallest ids, nulls last and
    equal ids in the order of their vectors; fewer rows give fewer entries.
    Vectors shorter than the longest, or whose length ``parts`` does not divide, are
    padded with zeros, empty ones included. Repeated rows are rows like others.
    Integers are exact at any size; an error beyond 64 bits is null, and so is
    the sum of its label. Null labels are one group. An empty table gives no row.
    Other columns, whatever their names, play no part.
    """
    spark = vectors.sparkSession
    kept = vectors.select(
        F.col(id_col).alias("id"),
        F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    ).where(
        F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    )
    longest = kept.agg(F.max(F.size("vector")).alias("n")).first()["n"] or 0
    width = parts * math.ceil(longest / parts)
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    start = _integers(first["vector"].combine_chunks(), width, scale)
    books = Codebooks([_narrow(b) for b in np.split(start, parts, axis=1)])
    if len(start):
        for _ in range(rounds):
            books = _moved(kept, width, scale, books)
    shared = spark.sparkContext.broadcast(books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, error = shared.value.assign(_integers(batch.column(2), width, scale))
            raw = codes.astype(np.uint8).tobytes().hex()
            size = 2 * parts
            fits = [int(e) if e < 1 << 63 else None for e in error.tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([raw[i : i + size] for i in range(0, len(raw), size)], pa.string()),
                    pa.array(fits, pa.int64()),
                ],
                names=["id", "label", "code", "error"],
            )

    kinds = {c: kept.schema[c].dataType.simpleString() for c in ("id", "label")}
    coded = materialise(
        kept.mapInArrow(code, f"id {kinds['id']}, label {kinds['label']}, code string, error long"),
        "codes",
    )
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = materialise(
        coded.df.groupBy(F.col("label").alias("own"))
        .agg(F.when(F.count_if(F.col("error").isNull()) == 0, total).alias("total")),
        "label-errors",
        F.lit(64),
    )
    digest = hashlib.sha256(books.text().encode()).hexdigest()
    return coded.df.join(bounded(sums), F.col("label").eqNullSafe(F.col("own")), "left").select(
        F.col("id").alias(id_col),
        "code",
        "error",
        F.col("total").try_cast("bigint").alias("label_error"),
        F.lit(digest).alias("codebooks_sha256"),
    )
