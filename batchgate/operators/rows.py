"""Structural gate and row rules, as columns.

A rule is a column holding the detail text where it fires and null where it
does not. Rows carry only flags through the pipeline; the violation arrays
are built for the rows that need them.

Building an expression tree from Python takes a round trip per node, so the
trees are built once and reused.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate import schema as S
from batchgate.functions import is_blank, parse_iso_date, parse_number, shown

MISSING = "missing_required_field"


def as_of_column(as_of: date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def violation(rule: str, severity: str, detail: Column) -> Column:
    """Violation struct, or null where ``detail`` is null."""
    entry = F.struct(
        F.lit(rule).alias("rule"),
        F.lit(severity).alias("severity"),
        detail.alias("detail"),
    )
    return F.when(detail.isNotNull(), entry)


def present(*violations: Column) -> Column:
    return F.array_compact(F.array(*violations)).cast(S.VIOLATIONS_DDL)


# --- structural gate -------------------------------------------------------


@cache
def parsed_columns() -> dict[str, Column]:
    return {
        "amount_num": parse_number(F.col("amount")),
        "txn_dt": parse_iso_date(F.col("transaction_date")),
        "post_dt": parse_iso_date(F.col("posted_date")),
    }


@cache
def any_required_blank() -> Column:
    blank = F.lit(False)
    for name in S.REQUIRED_COLUMNS:
        blank = blank | is_blank(F.col(name))
    return blank


@cache
def structurally_ok() -> Column:
    return ~any_required_blank() & F.col("amount_num").isNotNull() & F.col("txn_dt").isNotNull()


@cache
def structural_violations() -> Column:
    """Every blank required field, or else the first value that does not parse."""
    blanks = [
        violation(
            MISSING,
            S.CRITICAL,
            F.when(is_blank(F.col(name)), F.lit(f"Required field '{name}' is blank.")),
        )
        for name in S.REQUIRED_COLUMNS
    ]
    unparsed = F.when(
        F.col("amount_num").isNull(),
        F.concat(F.lit("amount value '"), F.col("amount"), F.lit("' does not parse as a number.")),
    ).when(
        F.col("txn_dt").isNull(),
        F.concat(
            F.lit("transaction_date value '"),
            F.col("transaction_date"),
            F.lit("' is not a valid date."),
        ),
    )
    return F.when(any_required_blank(), present(*blanks)).otherwise(
        present(violation(MISSING, S.CRITICAL, unparsed))
    )


@cache
def result_id() -> Column:
    return F.when(is_blank(F.col("transaction_id")), F.lit("UNKNOWN")).otherwise(
        F.col("transaction_id")
    )


# --- row rules -------------------------------------------------------------


def _one_of(column: Column, values) -> Column:
    return F.coalesce(column.isin(list(values)), F.lit(False))


def _unknown_value(as_of: Column) -> Column:
    status, currency = F.col("status"), F.col("currency")
    return F.when(
        ~_one_of(status, S.STATUSES),
        F.concat(F.lit("status '"), shown(status), F.lit("' not recognized.")),
    ).when(
        ~_one_of(currency, S.CURRENCIES),
        F.concat(F.lit("currency '"), shown(currency), F.lit("' not recognized.")),
    )


def _dates_disagree(as_of: Column) -> Column:
    return (
        F.when(F.col("post_dt").isNull(), "posted_date is missing or unparseable.")
        .when(F.col("post_dt") < F.col("txn_dt"), "posted_date precedes transaction_date.")
        .when(F.col("txn_dt") > as_of, "transaction_date is in the future.")
    )


def _wrong_sign(as_of: Column) -> Column:
    kind, amount = F.col("transaction_type"), F.col("amount_num")
    number = ~F.isnan(amount)
    return F.when(
        _one_of(kind, S.POSITIVE_TYPES) & number & (amount < 0),
        F.concat(F.lit("Negative amount on "), kind, F.lit(".")),
    ).when(
        _one_of(kind, S.NEGATIVE_TYPES) & number & (amount > 0),
        F.concat(F.lit("Positive amount on "), kind, F.lit(".")),
    )


def _failed_with_amount(as_of: Column) -> Column:
    return F.when(
        (F.col("status") == "failed") & (F.col("amount_num") != 0),
        F.lit("status is 'failed' but amount is nonzero."),
    )


def _zero_amount(as_of: Column) -> Column:
    return F.when(F.col("amount_num") == 0, F.lit("amount is 0.00."))


@dataclass(frozen=True)
class RowRule:
    """A check on one structurally sound row. ``detail`` gets the as-of date."""

    name: str
    severity: str
    detail: Callable[[Column], Column]


# Evaluated in this order. A further rule is one further entry.
ROW_RULES = (
    RowRule("invalid_enum_value", S.WARNING, _unknown_value),
    RowRule("date_logic_violation", S.CRITICAL, _dates_disagree),
    RowRule("amount_sign_mismatch", S.WARNING, _wrong_sign),
    RowRule("status_amount_inconsistency", S.WARNING, _failed_with_amount),
    RowRule("zero_value_transaction", S.WARNING, _zero_amount),
)


@cache
def rule_violations(
    as_of: date | str | None = None, rules: tuple[RowRule, ...] = ROW_RULES
) -> Column:
    day = as_of_column(as_of)
    return present(*[violation(r.name, r.severity, r.detail(day)) for r in rules])


@cache
def rule_flags(
    as_of: date | str | None = None, rules: tuple[RowRule, ...] = ROW_RULES
) -> dict[str, Column]:
    """``rule_critical`` and ``rule_warning``: does a rule of that severity fire?"""
    day = as_of_column(as_of)
    fires = {S.CRITICAL: F.lit(False), S.WARNING: F.lit(False)}
    for rule in rules:
        fires[rule.severity] = fires[rule.severity] | rule.detail(day).isNotNull()
    return {f"rule_{severity}": F.col("ok") & fired for severity, fired in fires.items()}


def with_all_columns(rows: DataFrame) -> DataFrame:
    """Columns a batch lacks are absent (null) in every row of it."""
    missing = [c for c in S.TRANSACTION_COLUMNS if c not in rows.columns]
    return rows.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else rows


def check_rows(
    rows: DataFrame,
    as_of: date | str | None = None,
    rules: tuple[RowRule, ...] = ROW_RULES,
) -> DataFrame:
    """Add parsed values, ``ok``, ``rule_critical`` and ``rule_warning``.

    Raw text columns stay as they came. No shuffle.
    """
    parsed = with_all_columns(rows).withColumns(parsed_columns())
    return parsed.withColumn("ok", structurally_ok()).withColumns(rule_flags(as_of, rules))
