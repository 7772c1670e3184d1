"""SimHash near copies: fingerprints, and pairs of them by a generalised pigeonhole.

A fingerprint has 64 bits, each the majority of the hashes of a text's shingles.
Two fingerprints within ``RADIUS`` bits are linked. To find them:

1. Bits that go together are grouped, so that the other groups stay selective.
   The bits fall into m parts by the counts of how often two are set together.
2. If the thresholds of the parts sum up to ``RADIUS - m + 1`` (-1 leaves a part
   out), some part of any linked pair differs in no more bits than its threshold.
   Every fingerprint gets thresholds of its own by dynamic programming on the
   estimated number of candidates: crowded values are left out or probed
   exactly, thin ones widely. If all that costs more than looking up every
   fingerprint within the radius, that is done, so the candidates of a
   fingerprint are bounded whatever the data.
3. Probes meet the fingerprints of their value; each pair found is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import Table, bounded, connected, materialise, release
from batchgate.operators.lookups import lookup

BITS = 64
RADIUS = 2
SEED = 42
# Values of a part that are listed with their exact counts; others count as average.
LISTED = 1 << 17
CROWDED = 8
# Texts are hashed in steps of about so many bytes, and fingerprints probed in such blocks.
STEP = 1 << 20
PROBED = 1 << 20
_SPACE = b" \t\n\r\x0b\x0c"


def _pieces(text: bytes, step: int) -> Iterator[list[bytes]]:
    """The words of a text, in steps that end between words."""
    at = 0
    while len(text) - at > step:
        end = at + step
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        yield text[at:end].split()
        at = end
    yield text[at:].split()


def fingerprint(text: bytes, size: int = 3, seed: int = SEED, step: int = STEP) -> int:
    """Bit k is set if it is in over half the XXH64 values of the text's shingles."""
    from xxhash import xxh64_intdigest

    ones, n, held = np.zeros(BITS, np.int64), 0, []
    for words in _pieces(text.lower(), step):
        held += words
        if len(held) < size:
            continue
        joined = b" ".join(held)
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
        # No word holds a space, so shingles are slices of the joined words.
        starts = [0, *(gaps + 1).tolist()][: len(held) - size + 1]
        ends = [*gaps.tolist(), len(joined)][size - 1 :]
        hashes = np.fromiter(
            (xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends, strict=True)),
            np.uint64,
            len(starts),
        )
        bits = np.unpackbits(hashes.astype("<u8", copy=False).view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, BITS).sum(0, dtype=np.uint32)
        n += len(hashes)
        held = held[len(held) - size + 1 :] if size > 1 else []
    if not n:
        return xxh64_intdigest(b" ".join(held), seed) if held else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(id, fp): every text's fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            found = (fingerprint(t.as_py() or b"", size) for t in texts)
            fps = np.fromiter(found, np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, f"id {kind}, fp long")


# --- parts of correlated bits ---------------------------------------------------


def _set_together(fps: DataFrame) -> np.ndarray:
    """How often two bits are set together: 64 x 64 sums, whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            raw = batch.column(0).to_numpy().astype("<i8").view(np.uint8)
            bits = np.unpackbits(raw, bitorder="little").reshape(-1, BITS).astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
        i, j = np.divmod(np.arange(BITS * BITS), BITS)
        yield pa.RecordBatch.from_pydict({"i": i, "j": j, "n": total.reshape(-1)})

    sums = fps.mapInArrow(count, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    both = np.zeros((BITS, BITS), np.int64)
    for r in sums.collect():
        both[r["i"], r["j"]] = r["n"]
    return both


def correlated_parts(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """``parts`` groups of bits, correlated bits together, of sizes that differ by one at most."""
    p = both.diagonal() / max(n, 1)
    spread = np.sqrt(p * (1 - p))
    scale = np.outer(spread, spread)
    together = np.abs(np.divide(both / max(n, 1) - np.outer(p, p), scale, out=np.zeros_like(scale), where=scale > 0))
    np.fill_diagonal(together, 0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        room = BITS // parts + (k < BITS % parts)
        rest = sorted(free)
        own = [max(rest, key=lambda b: (together[b, rest].sum(), -b))]
        while len(own) < room:
            rest = sorted(free.difference(own))
            own.append(max(rest, key=lambda b: (together[b, own].sum(), -b)))
        free -= set(own)
        groups.append(sorted(own))
    return groups


def _flips(bits: list[int], radius: int) -> np.ndarray:
    """Masks that change at most ``radius`` of the bits."""
    masks = [sum(1 << b for b in some) for r in range(radius + 1) for some in combinations(bits, r)]
    return np.array(masks, np.uint64)


# --- thresholds -------------------------------------------------------------------


@dataclass(frozen=True)
class Plan:
    """Parts with their listed values, and what a probe of any other value finds on average."""

    parts: list[list[int]]
    values: list[np.ndarray]  # per part: crowded values, ascending
    counts: list[np.ndarray]
    average: list[float]
    cut: int  # values with more fingerprints are not probed

    def masks(self) -> np.ndarray:
        return np.array([sum(1 << b for b in p) for p in self.parts], np.uint64)

    def found(self, part: int, values: np.ndarray) -> np.ndarray:
        """Exact count of listed values, else -1."""
        listed = self.values[part]
        if not len(listed):
            return np.full(values.shape, -1, np.int64)
        at = np.minimum(np.searchsorted(listed, values), len(listed) - 1)
        return np.where(listed[at] == values, self.counts[part][at], -1)

    def allocate(self, fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
        """Thresholds per fingerprint and part; a row of -2 stands for all parts at once."""
        m, n = len(self.parts), len(fps)
        choices = range(-1, radius + 1)
        budget = radius - m + 1
        # least[s]: cost of the parts so far with thresholds that sum up to s.
        least = {0: np.zeros(n)}
        chosen: list[dict[int, np.ndarray]] = []
        for i, mask in enumerate(self.masks()):
            known = self.found(i, fps & mask)
            own = np.where(known < 0, self.average[i], known)
            width = [len(_flips(self.parts[i], t)) if t >= 0 else 0 for t in choices]
            costs = [own + w + (w - 1) * self.average[i] if w else np.zeros(n) for w in width]
            following: dict[int, np.ndarray] = {}
            pick: dict[int, np.ndarray] = {}
            for s, so_far in least.items():
                for t, cost in zip(choices, costs, strict=True):
                    value = so_far + cost
                    best = following.get(s + t)
                    if best is None:
                        following[s + t], pick[s + t] = value, np.full(n, t)
                    else:
                        better = value < best
                        following[s + t] = np.where(better, value, best)
                        pick[s + t] = np.where(better, t, pick[s + t])
            least = following
            chosen.append(pick)
        result = np.empty((n, m), np.int64)
        at = np.full(n, budget)
        for i in reversed(range(m)):
            for s in np.unique(at):
                result[at == s, i] = chosen[i][int(s)][at == s]
            at = at - result[:, i]
        result[least[budget] > len(_flips(list(range(BITS)), radius))] = -2
        return result

    def probes(self, fps: np.ndarray, radius: int = RADIUS):
        """Yields (part, values, fingerprints); part ``len(parts)`` is the whole."""
        taken = self.allocate(fps, radius)
        whole = taken[:, 0] == -2
        for i, mask in enumerate(self.masks()):
            for t in range(radius + 1):
                own = np.flatnonzero(taken[:, i] == t)
                flips = _flips(self.parts[i], t)
                for some in np.array_split(own, -(-len(own) * len(flips) // PROBED) or 1):
                    values = (fps[some] & mask)[:, None] ^ flips[None, :]
                    # A value too crowded to be probed: the fingerprint is looked up whole.
                    over = (self.found(i, values) > self.cut).any(1)
                    whole[some[over]] = True
                    sound = some[~over]
                    yield i, values[~over].reshape(-1), np.repeat(fps[sound], len(flips))
        # Fingerprints are distinct, so none looks for itself.
        flips = _flips(list(range(BITS)), radius)[1:]
        own = np.flatnonzero(whole)
        for some in np.array_split(own, -(-len(own) * len(flips) // PROBED) or 1):
            values = fps[some][:, None] ^ flips[None, :]
            yield len(self.parts), values.reshape(-1), np.repeat(fps[some], len(flips))


def _parts_for(n: int, radius: int) -> int:
    """The number of parts with the least cost for ``n`` fingerprints of random bits."""

    def cost(m: int) -> float:
        if radius - m + 1 > 0:
            return len(_flips(list(range(BITS // m)), radius - m + 1)) + m - 1 + n / 2 ** (BITS // m)
        return (radius + 1) * (1 + n / 2 ** (BITS // m))

    return min(range(2, radius + 2), key=cost)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _values(plan_masks: np.ndarray) -> Column:
    """Per part its number and the fingerprint's bits in it."""
    some = [
        F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(int(m)))).alias("value"))
        for i, m in enumerate(plan_masks)
    ]
    return F.explode(F.array(*some)).alias("at")


def make_plan(fps: DataFrame, n: int, radius: int = RADIUS, listed: int = LISTED) -> Plan:
    """Parts, and the exact counts of their most crowded values (``listed`` at most)."""
    parts = correlated_parts(_set_together(fps), n, _parts_for(n, radius))
    blank = Plan(parts, [], [], [], 0)
    counts = materialise(
        fps.select("fp", _values(blank.masks())).groupBy("at.part", "at.value")
        .agg(F.count(F.lit(1)).alias("n")).withColumn("step", F.floor(4 * F.log2("n")).cast("int")),
        "part-values",
    )
    steps = counts.df.groupBy("part", "step").agg(
        F.count(F.lit(1)).alias("values"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn")
    ).collect()
    # The lowest step from which on all values can be listed.
    lowest, total = 1 << 30, 0
    for step in sorted({r["step"] for r in steps if r["n"] >= CROWDED * r["values"]}, reverse=True):
        total += sum(r["values"] for r in steps if r["step"] == step)
        if total > listed:
            break
        lowest = step
    crowded = counts.df.where(F.col("step") >= lowest).select("part", "value", "n").toArrow()
    part, value = crowded["part"].to_numpy(), crowded["value"].to_numpy().view(np.uint64)
    many = crowded["n"].to_numpy()
    values, sizes, average = [], [], []
    for i in range(len(parts)):
        own = np.flatnonzero(part == i)
        own = own[np.argsort(value[own])]
        values.append(value[own])
        sizes.append(many[own])
        rest = [r for r in steps if r["part"] == i and r["step"] < lowest]
        average.append(float(sum(r["nn"] for r in rest)) / max(1, sum(r["n"] for r in rest)))
    release(fps.sparkSession, counts.path)
    whole = len(_flips(list(range(BITS)), radius))
    return Plan(parts, values, sizes, average, max(whole, int(2 ** ((lowest + 1) / 4)) if lowest < 1 << 30 else 0))


def links(fps: DataFrame, n: int, radius: int = RADIUS, listed: int = LISTED) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct fingerprints ``fp`` within ``radius`` bits."""
    spark = fps.sparkSession
    plan = make_plan(fps, n, radius, listed)
    shared = spark.sparkContext.broadcast(plan)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            for part, values, a in shared.value.probes(own, radius):
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(np.full(len(a), part, np.int32)),
                        "value": pa.array(values.view(np.int64)),
                        "a": pa.array(a.view(np.int64)),
                    }
                )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for i, mask in enumerate([*own.masks(), np.uint64((1 << BITS) - 1)]):
                values = fps & mask
                probed = own.found(i, values) <= own.cut if i < len(own.parts) else slice(None)
                some = values[probed]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(np.full(len(some), i, np.int32)),
                        "value": pa.array(some.view(np.int64)),
                        "b": pa.array(fps[probed].view(np.int64)),
                    }
                )

    # The smaller of two fingerprints finds the larger one.
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    return (
        fps.select("fp").mapInArrow(probe, "part int, value long, a long")
        .join(fps.select("fp").mapInArrow(index, "part int, value long, b long"), ["part", "value"])
        .where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()
    )


def components(
    docs: DataFrame,
    size: int = 3,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, ``fingerprint``, ``component_id``, the smallest id reachable by links.

    Words are runs of anything but ASCII white space, A-Z in lower case; shingles
    are ``size`` words joined by one space, repeats included, or all words of a text
    that has fewer. Null, empty and blank texts have fingerprint zero and are
    linked like any other. Repeated rows and null ids are rows like others; a null
    id names a component only if all its ids are null. Texts of any length are
    hashed whole, in steps. An empty table gives no row. Other columns, whatever
    their names, play no part.
    """
    spark = docs.sparkSession
    rows = materialise(
        fingerprints(docs, size, id_col, text_col).withColumns(
            {
                "row": F.monotonically_increasing_id(),
                "fingerprint": F.lpad(F.lower(F.hex("fp")), 16, "0"),
            }
        ),
        "fingerprints",
    ).df
    classes = materialise(
        rows.groupBy("fp", "fingerprint").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least")),
        "classes",
    )
    reached = connected(links(classes.df.select("fp"), max(classes.rows, 1), radius))
    labelled = materialise(
        classes.df.join(bounded(reached), F.col("fp") == F.col("node"), "left").select(
            "fingerprint", "n", "least", F.coalesce("root", "fp").alias("label")
        ),
        "labelled",
    )
    best = materialise(labelled.df.groupBy("label").agg(F.min("least").alias("component_id")), "best")
    named: Table = materialise(
        labelled.df.join(bounded(best), "label").select("fingerprint", "n", "component_id"),
        "named",
        F.lit(32),
    )
    release(spark, classes.path, reached.path, labelled.path, best.path)
    # Many texts may share a fingerprint: the lookup spreads rows of hot keys.
    found = lookup(rows, named, {"fingerprint": F.col("fingerprint")}, ["component_id"], "n", F.col("row"))
    return found.select(F.col("id").alias(id_col), "fingerprint", "component_id")
