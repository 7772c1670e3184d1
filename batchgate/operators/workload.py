"""The four-stage workload: lenient parse, flags, counts.

Unlike batch validation it takes the whole input for one file and counts
repeated ids over all rows, sound or not.
"""

from __future__ import annotations

from datetime import date
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate import schema as S
from batchgate.functions import is_blank, parse_iso_date, parse_number
from batchgate.operators.ids import NotableIds, attach_ids, notable_ids
from batchgate.operators.rows import any_required_blank, as_of_column


@cache
def _parsed_columns() -> dict[str, Column]:
    return {
        "amount_parsed": parse_number(F.col("amount")),
        "transaction_date_parsed": parse_iso_date(F.col("transaction_date")),
        "posted_date_parsed": parse_iso_date(F.col("posted_date")),
    }


def bench_parse(rows: DataFrame) -> DataFrame:
    """Add parsed amount and dates, null where the text does not parse."""
    return rows.withColumns(_parsed_columns())


@cache
def _own_id() -> Column:
    return F.col("transaction_id")


@cache
def _has_id() -> Column:
    return ~is_blank(F.col("transaction_id"))


@cache
def _wanted_id() -> Column:
    return F.when(
        F.col("transaction_type") == "refund",
        F.coalesce(F.col("related_transaction_id"), F.lit("")),
    )


def bench_ids(rows: DataFrame) -> NotableIds:
    """Repeated ids and missing referents over the whole input."""
    return notable_ids(rows, [], _own_id(), _has_id(), _wanted_id())


def attach_whole_input(rows: DataFrame, ids: NotableIds, **limits) -> DataFrame:
    """Add ``same_id`` and ``orphan`` with the whole input as one file."""
    spread = F.monotonically_increasing_id()
    return attach_ids(rows, ids, [], _own_id(), _has_id(), _wanted_id(), spread, **limits)


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


@cache
def row_flags(as_of: date | str | None = None) -> dict[str, Column]:
    """Flags that depend on the row alone, false where a value is missing."""
    amount = F.col("amount_parsed")
    txn, posted = F.col("transaction_date_parsed"), F.col("posted_date_parsed")
    kind = F.col("transaction_type")
    number = ~F.isnan(amount)
    return {
        "missing_required": any_required_blank() | amount.isNull() | txn.isNull(),
        "invalid_enum": ~_sure(F.col("status").isin(list(S.STATUSES)))
        | ~_sure(F.col("currency").isin(list(S.CURRENCIES))),
        "date_logic": posted.isNull()
        | _sure(posted < txn)
        | _sure(txn > as_of_column(as_of)),
        "amount_sign": _sure(
            number
            & (
                (kind.isin(S.POSITIVE_TYPES) & (amount < 0))
                | (kind.isin(S.NEGATIVE_TYPES) & (amount > 0))
            )
        ),
        "status_amount": _sure((F.col("status") == "failed") & (amount != 0)),
        "zero_value": _sure(amount == 0),
    }


@cache
def _own_flags(as_of: date | str | None) -> dict[str, Column]:
    flags = row_flags(as_of)
    return {
        "own_critical": flags["missing_required"] | flags["date_logic"],
        "own_warning": flags["invalid_enum"]
        | flags["amount_sign"]
        | flags["status_amount"]
        | flags["zero_value"],
    }


def bench_screen(parsed: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """Add ``own_critical`` and ``own_warning``, from the row alone."""
    return parsed.withColumns(_own_flags(as_of))


def bench_settle(screened: DataFrame, ids: NotableIds, **limits) -> DataFrame:
    """Add ``critical`` and ``warning``; a critical row carries no warning."""
    known = attach_whole_input(screened, ids, **limits)
    critical = F.col("own_critical") | (F.col("same_id") > 1) | F.col("orphan")
    return (
        known.withColumn("critical", critical)
        .withColumn("warning", F.col("own_warning") & ~F.col("critical"))
        .drop("own_critical", "own_warning", "same_id", "orphan")
    )


def bench_validate(parsed: DataFrame, as_of: date | str | None = None, **limits) -> DataFrame:
    """Flags of every row: ``critical``, or else ``warning``."""
    return bench_settle(bench_screen(parsed, as_of), bench_ids(parsed), **limits)


@cache
def _type_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~F.col("critical")).alias("passed"),
        F.count_if(F.col("critical")).alias("rejected_critical"),
        F.count_if("warning").alias("flagged_warning_only"),
    ]


def bench_by_type(flagged: DataFrame) -> DataFrame:
    """Counts per transaction type, rows without a type included."""
    return flagged.groupBy("transaction_type").agg(*_type_counts())


def bench_aggregate(by_type: DataFrame) -> DataFrame:
    """Counts over the whole input, from those per type."""
    return by_type.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("total_rows", "passed", "rejected_critical", "flagged_warning_only")
        ]
    )
