"""Defects to put into clean rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate import schema as S
from batchgate.functions import draw, parse_number, pick, uniform

Draws = Callable[[int], Column]


def _money(value: Column) -> Column:
    return F.format_string("%.2f", value)


def _amount_or(default: float) -> Column:
    return F.coalesce(parse_number(F.col("amount")), F.lit(default))


def _blank_a_field(u: Draws) -> dict[str, Column]:
    fields = ["account_id", "amount", "transaction_date"]
    hit = pick(u(0), fields)
    return {f: F.when(hit == f, F.lit("")).otherwise(F.col(f)) for f in fields}


def _unchanged(u: Draws) -> dict[str, Column]:
    return {}


def _unknown_value(u: Draws) -> dict[str, Column]:
    in_status = u(0) < 0.5
    number = F.floor(u(1) * F.lit(99.0)) + 1
    return {
        "status": F.when(
            in_status, F.concat(F.lit("unknown_status_"), number.cast("string"))
        ).otherwise(F.col("status")),
        "currency": F.when(in_status, F.col("currency")).otherwise(
            pick(u(2), ["XXX", "ZZZ", "N/A"])
        ),
    }


def _shifted(days: Column | int) -> Column:
    return F.date_add(F.col("transaction_date").try_cast("date"), days).cast("string")


def _dates_apart(u: Draws) -> dict[str, Column]:
    early_posting = u(0) < 0.5
    return {
        "posted_date": F.when(early_posting, F.col("transaction_date")).otherwise(
            F.col("posted_date")
        ),
        "transaction_date": F.when(early_posting, _shifted(3)).otherwise(_shifted(365)),
    }


def _nowhere_refund(u: Draws) -> dict[str, Column]:
    lost = F.lit(90_000_000) + F.floor(u(0) * F.lit(10_000_000.0))
    return {
        "transaction_type": F.lit("refund"),
        "amount": F.concat(F.lit("-"), _money(F.abs(_amount_or(1.0)))),
        "related_transaction_id": F.concat(F.lit("TXN-"), lost.cast("string")),
    }


def _sign_flipped(u: Draws) -> dict[str, Column]:
    amount = _amount_or(10.0)
    flipped = F.when(F.col("transaction_type").isin(S.POSITIVE_TYPES), -amount)
    return {"amount": _money(flipped.otherwise(F.abs(amount)))}


def _failed_with_amount(u: Draws) -> dict[str, Column]:
    return {"status": F.lit("failed"), "amount": _money(F.abs(_amount_or(10.0)))}


def _zeroed(u: Draws) -> dict[str, Column]:
    return {"amount": F.lit("0.00")}


@dataclass(frozen=True)
class Defect:
    """``change`` gets a source of uniform draws and returns the new columns."""

    name: str
    severity: str
    change: Callable[[Draws], dict[str, Column]]
    repeats: bool = False


# A row's defect is drawn from this list; a further defect is a further entry.
DEFECTS = [
    Defect("missing_required_field", S.CRITICAL, _blank_a_field),
    Defect("duplicate_transaction", S.CRITICAL, _unchanged, repeats=True),
    Defect("invalid_enum_value", S.WARNING, _unknown_value),
    Defect("date_logic_violation", S.CRITICAL, _dates_apart),
    Defect("orphaned_refund", S.CRITICAL, _nowhere_refund),
    Defect("amount_sign_mismatch", S.WARNING, _sign_flipped),
    Defect("status_amount_inconsistency", S.WARNING, _failed_with_amount),
    Defect("zero_value_transaction", S.WARNING, _zeroed),
]

_SELECT, _CHOOSE, _APPLY = 10, 11, 12
_BUCKET_BITS = 14
# So many rows of one bucket are ordered without counting them more finely.
_ORDERED = 1 << 16


def _key(order: str) -> Column:
    return F.col(order)


def exact_sample(
    rows: DataFrame, k: int | Callable[[int], int], score: Column, tie: str
) -> Column:
    """Condition that holds for exactly the ``k`` rows of least (score, tie).

    ``k`` may be a function of the number of rows, which the first count tells.
    ``score`` lies in [0, 2^32). The range holding the k-th row is narrowed by
    counting rows per bucket, until few enough are left in it to be ordered.
    """
    low, bits = 0, 32
    while True:
        inside = (score >= low) & (score < low + (1 << bits))
        bits -= _BUCKET_BITS
        bucket = F.floor((score - low) / (1 << bits)).alias("bucket")
        counts = rows.where(inside).groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
        # At most 2^14 records come back.
        held = counts.orderBy("bucket").collect()
        if low == 0 and bits + _BUCKET_BITS == 32:
            n = sum(found.n for found in held)
            k = k(n) if callable(k) else k
            if k <= 0 or k >= n:
                return F.lit(k > 0)
        for found in held:
            if found.n >= k:
                break
            k -= found.n
        low += found.bucket << bits
        if found.n <= _ORDERED or bits < _BUCKET_BITS:
            break
    cut = (
        rows.where((score >= low) & (score < low + (1 << bits)))
        .select(score.alias("s"), F.col(tie).alias("t"))
        .orderBy("s", "t")
        .limit(k)
        .agg(F.max(F.struct("s", "t")).alias("cut"))
        .first()
        .cut
    )
    return (score < cut.s) | ((score == cut.s) & (F.col(tie) <= cut.t))


def inject_defects(
    rows: DataFrame,
    rate: float,
    seed: int,
    order: str = "row_seq",
    defects: list[Defect] = DEFECTS,
) -> tuple[DataFrame, DataFrame]:
    """Put one defect each into ``max(1, int(n * rate))`` distinct rows.

    Returns the rows, with a second copy of those whose defect is repetition,
    and the manifest (transaction_id, defect, severity). ``order`` is an integer
    column unique over all rows.
    """
    score = draw(seed, _SELECT, _key(order))
    chosen = exact_sample(rows, lambda n: max(1, int(n * rate)), score, order)
    index = F.floor(uniform(seed, _CHOOSE, _key(order)) * F.lit(float(len(defects)))).cast("int")
    marked = rows.withColumn("__defect", F.when(chosen, index))

    def draws(slot: int) -> Column:
        return uniform(seed, _APPLY, _key(order), slot)

    changed: dict[str, Column] = {}
    for i, defect in enumerate(defects):
        for name, value in defect.change(draws).items():
            before = changed.get(name)
            hit = F.col("__defect") == i
            changed[name] = F.when(hit, value) if before is None else before.when(hit, value)
    # All new values are computed from the old row, in one projection.
    mutated = marked.withColumns({c: v.otherwise(F.col(c)) for c, v in changed.items()})
    repeating = [i for i, d in enumerate(defects) if d.repeats]
    again = F.col("__defect").isin(repeating) if repeating else F.lit(False)
    copies = F.when(again, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    out = mutated.select(*rows.columns, F.explode(copies).alias("is_copy"))

    names = F.array(*[F.lit(d.name) for d in defects])
    severities = F.array(*[F.lit(d.severity) for d in defects])
    manifest = marked.where(F.col("__defect").isNotNull()).select(
        "transaction_id",
        F.get(names, F.col("__defect")).alias("defect"),
        F.get(severities, F.col("__defect")).alias("severity"),
    )
    return out, manifest
