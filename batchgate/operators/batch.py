"""Validation of whole batches.

A batch is the rows of one file; every whole-file rule is scoped by
``source_key``, so any number of files go through one job side by side.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate import schema as S
from batchgate.functions import shown
from batchgate.operators.ids import NotableIds, attach_ids, notable_ids
from batchgate.operators.linkage import dense_index
from batchgate.operators.lookups import lookup
from batchgate.operators.rows import (
    ROW_RULES,
    RowRule,
    check_rows,
    present,
    result_id,
    rule_violations,
    structural_violations,
    violation,
)
from batchgate.session import Table, materialise, release

SCOPE = ["source_key"]

COUNTS = ["total_rows", "passed", "rejected_critical", "flagged_warning_only"]


@cache
def duplicate_detail() -> Column:
    return F.when(
        F.col("same_id") > 1,
        F.concat(
            F.lit("transaction_id appears "),
            F.col("same_id").cast("string"),
            F.lit(" times in the file."),
        ),
    )


def orphan_detail(related: Column) -> Column:
    return F.concat(
        F.lit("related_transaction_id '"), shown(related), F.lit("' not found in file.")
    )


def _orphan_entry(related: Column) -> Column:
    return violation("orphaned_refund", S.CRITICAL, orphan_detail(related))


@cache
def wanted_id() -> Column:
    """Id a sound refund refers to, blank if it names none; null for other rows."""
    refund = F.col("ok") & F.coalesce(F.col("transaction_type") == "refund", F.lit(False))
    return F.when(refund, F.coalesce(F.col("related_transaction_id"), F.lit("")))


@dataclass(frozen=True)
class ValidatedBatch:
    """Judged rows and what is derived from them.

    ``rows`` has the raw columns plus ``ok``, ``same_id``, ``orphan``,
    ``critical`` (rejected) and ``flagged`` (any violation).
    """

    rows: DataFrame
    as_of: date | str | None
    rules: tuple[RowRule, ...]
    ids: NotableIds
    staged: Table
    scope: list[str]

    def valid_rows(self) -> DataFrame:
        """Rows without a critical violation, as raw text, in column order."""
        return self.rows.where(~F.col("critical")).select(
            *self.scope, "row_seq", *S.TRANSACTION_COLUMNS
        )

    def exceptions(self) -> DataFrame:
        """Every row with a violation, with its ordered violation list.

        Within a file structural failures come first, then the others, each in
        row order: sort by (``ok``, ``row_seq``). A row lists its own violations;
        ``shared`` marks rows whose id is repeated, to which the id's entries in
        ``shared_violations()`` apply as well.
        """
        orphan = F.when(F.col("orphan"), _orphan_entry(F.col("related_transaction_id")))
        whole_file = F.concat(
            present(violation("duplicate_transaction", S.CRITICAL, duplicate_detail())),
            present(orphan).cast(S.VIOLATIONS_DDL),
        )
        sound = F.concat(rule_violations(self.as_of, self.rules), whole_file)
        return self.rows.where("flagged").select(
            *self.scope,
            "row_seq",
            "ok",
            result_id().alias("transaction_id"),
            F.when(F.col("ok"), sound).otherwise(structural_violations()).alias("violations"),
            (F.col("same_id") > 1).alias("shared"),
        )

    def exceptions_long(self) -> DataFrame:
        """One line per violation; ``pos`` counts from 0 within a row."""
        return self.exceptions().select(
            *self.scope,
            "row_seq",
            "transaction_id",
            F.posexplode("violations").alias("pos", "v"),
        ).select(*self.scope, "row_seq", "pos", "transaction_id", "v.rule", "v.severity", "v.detail")

    def shared_violations(self) -> DataFrame:
        """Orphan entries that hold for all rows of a repeated id.

        The rows concerned are those marked ``shared`` in ``exceptions()``;
        an id's entries, in ``row_seq`` order, apply to each of them. Listing
        them per row would grow with the square of the repetition.
        """
        return self.rows.where((F.col("same_id") > 1) & F.col("orphan")).select(
            *self.scope,
            "transaction_id",
            "row_seq",
            F.lit("orphaned_refund").alias("rule"),
            F.lit(S.CRITICAL).alias("severity"),
            orphan_detail(F.col("related_transaction_id")).alias("detail"),
        )

    def exceptions_full(self, rows_at_once: int = 4096, entries_at_once: int = 1024) -> DataFrame:
        """One line per violation, with every entry that an id's rows share on each of them.

        A row of a repeated id lists its own violations, the duplicate entry, and the
        orphan entries of all rows of its id in ``row_seq`` order. That output grows
        with the square of the repetition, so it is made in pieces: up to
        ``rows_at_once`` rows of an id (about) meet up to ``entries_at_once`` of its
        entries in one task, however often the id occurs.
        """
        scope, key = self.scope, [*self.scope, "transaction_id"]
        exceptions = self.exceptions()
        own = exceptions.select(
            *scope, "row_seq", "transaction_id", "shared", F.posexplode("violations").alias("pos", "v")
        ).where(~(F.col("shared") & (F.col("v.rule") == "orphaned_refund")))

        # Entries, numbered within their id, in blocks.
        entries = dense_index(
            self.rows.where((F.col("same_id") > 1) & F.col("orphan")).select(
                *key, "row_seq", "same_id", "related_transaction_id"
            ),
            key,
            "row_seq",
            "rank",
        )
        listed = materialise(entries.withColumn("k", F.col("rank") - 1), "entries")
        pieces = F.ceil(F.col("same_id") / rows_at_once).cast("bigint")
        blocks = listed.df.select(
            *key,
            F.floor(F.col("k") / entries_at_once).alias("block"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1)).alias("piece"),
            "k",
            orphan_detail(F.col("related_transaction_id")).alias("detail"),
        )
        width = F.lit(48) + F.octet_length("transaction_id")
        many = materialise(
            listed.df.groupBy(*key).agg(F.count(F.lit(1)).alias("many"), F.max("same_id").alias("n")),
            "entry-counts",
            width,
        )
        # A shared row's own entries: all but the orphan one, which is among the id's.
        before = F.size(F.filter("violations", lambda v: v["rule"] != "orphaned_refund"))
        members = lookup(
            exceptions.where("shared").select(*key, "row_seq", before.alias("before")),
            many,
            {c: F.col(c) for c in key},
            ["many", "n"],
            "n",
            F.col("row_seq"),
        ).where(F.col("many").isNotNull())
        asked = members.select(
            *key,
            "row_seq",
            "before",
            F.pmod(F.xxhash64("row_seq"), F.ceil(F.col("n") / rows_at_once).cast("bigint")).alias("piece"),
            F.explode(
                F.sequence(
                    F.lit(0).cast("bigint"), F.ceil(F.col("many") / entries_at_once).cast("bigint") - 1
                )
            ).alias("block"),
        )
        common = asked.join(blocks, [*key, "block", "piece"]).select(
            *scope,
            "row_seq",
            (F.col("before") + F.col("k")).cast("int").alias("pos"),
            "transaction_id",
            F.lit("orphaned_refund").alias("rule"),
            F.lit(S.CRITICAL).alias("severity"),
            "detail",
        )
        return own.select(
            *scope, "row_seq", "pos", "transaction_id", "v.rule", "v.severity", "v.detail"
        ).unionByName(common)

    def summary(self, files: DataFrame | None = None) -> DataFrame:
        """Row counts per file. ``files`` adds zero counts for files without rows."""
        counts = self.rows.groupBy(*self.scope).agg(*count_columns())
        if files is None:
            return counts
        zeros = {c: F.coalesce(F.col(c), F.lit(0)).alias(c) for c in COUNTS}
        return files.select(*self.scope).join(counts, self.scope, "left").select(
            *self.scope, *zeros.values()
        )

    def release(self) -> None:
        """Drop the scratch tables. Results must be consumed first."""
        release(self.rows.sparkSession, self.staged.path, *self.ids.paths)


@cache
def count_columns() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~F.col("critical")).alias("passed"),
        F.count_if(F.col("critical")).alias("rejected_critical"),
        F.count_if(F.col("flagged") & ~F.col("critical")).alias("flagged_warning_only"),
    ]


def judge(checked: DataFrame, ids: NotableIds, scope: list[str] = SCOPE, **limits) -> DataFrame:
    out = attach_ids(
        checked,
        ids,
        scope,
        own=F.col("transaction_id"),
        counted=F.col("ok"),
        wanted=wanted_id(),
        spread=F.col("row_seq"),
        **limits,
    )
    critical = ~F.col("ok") | F.col("rule_critical") | (F.col("same_id") > 1) | F.col("orphan")
    return out.withColumn("critical", critical).withColumn(
        "flagged", F.col("critical") | F.col("rule_warning")
    )


def validate_batch(
    rows: DataFrame,
    as_of: date | str | None = None,
    rules: tuple[RowRule, ...] = ROW_RULES,
    scope: list[str] = SCOPE,
    **limits,
) -> ValidatedBatch:
    """Structural gate, row rules and whole-file rules over all files at once.

    ``rows`` holds the text columns of a transaction, the ``scope`` columns
    that tell files apart, and ``row_seq``, which orders the rows of a file.

    Rows are checked once and written to a scratch table, from which the ids
    worth looking up are found and every result is derived: text is parsed a
    single time, and what runs over the table is simple enough to be compiled
    as one piece.
    """
    staged = materialise(check_rows(rows, as_of, rules), "staged")
    checked = staged.df
    ids = notable_ids(
        checked,
        scope,
        own=F.col("transaction_id"),
        counted=F.col("ok"),
        wanted=wanted_id(),
    )
    judged = judge(checked, ids, scope, **limits)
    return ValidatedBatch(judged, as_of, rules, ids, staged, list(scope))
