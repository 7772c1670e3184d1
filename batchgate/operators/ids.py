"""Facts about ids: how often each occurs, and which wanted ones do not exist.

One pass over the narrow columns answers both. Every row mentions its own id
and, for a refund, the id it refers to; counting mentions per id is a partial
aggregation, so a hot id leaves each task as a single record. Only the
notable ids are kept: repeated ones, and wanted ones that nobody has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate.functions import is_blank
from batchgate.operators.lookups import fits_broadcast, lookup
from batchgate.session import Table, materialise


def count_mentions(
    rows: DataFrame, scope: list[str], own: Column, counted: Column, wanted: Column
) -> DataFrame:
    """(scope, id, n_same, present, n_wanted) for every id mentioned."""
    mine = F.struct(
        own.alias("id"), counted.cast("int").alias("n"), F.lit(True).alias("here")
    )
    theirs = F.struct(wanted.alias("id"), F.lit(0).alias("n"), F.lit(False).alias("here"))
    both = F.when(is_blank(wanted), F.array(mine)).otherwise(F.array(mine, theirs))
    mentions = rows.select(*scope, F.inline(both)).where(~is_blank(F.col("id")))
    return mentions.groupBy(*scope, "id").agg(
        F.sum("n").alias("n_same"),
        F.bool_or("here").alias("present"),
        F.count_if(~F.col("here")).alias("n_wanted"),
    )


def raw_ids(rows: DataFrame, scope: list[str]) -> DataFrame:
    """Distinct non-blank ids, of all rows whether structurally sound or not."""
    return rows.where(~is_blank(F.col("transaction_id"))).select(*scope, "transaction_id").distinct()


def id_counts(checked: DataFrame, scope: list[str]) -> DataFrame:
    """Occurrences of each id among the structurally sound rows."""
    return checked.where("ok").groupBy(*scope, "transaction_id").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class NotableIds:
    """Repeated ids (``n_same``) and wanted ids nobody has (``lost``), each sized."""

    repeated: Table
    lost: Table

    @property
    def paths(self) -> list[str]:
        return [self.repeated.path]


def notable_ids(
    rows: DataFrame, scope: list[str], own: Column, counted: Column, wanted: Column
) -> NotableIds:
    is_repeated = F.col("n_same") > 1
    is_lost = (F.col("n_wanted") > 0) & ~F.col("present")
    facts = count_mentions(rows, scope, own, counted, wanted).where(is_repeated | is_lost)
    width = F.lit(48) + F.octet_length("id")
    for name in scope:
        width = width + F.octet_length(name)

    def part(condition: Column) -> dict[str, Column]:
        return {"rows": F.count_if(condition), "bytes": F.sum(F.when(condition, width))}

    table = materialise(
        facts,
        "ids",
        metrics={
            **{f"repeated_{k}": v for k, v in part(is_repeated).items()},
            **{f"lost_{k}": v for k, v in part(is_lost).items()},
        },
    )

    def sized(df: DataFrame, name: str) -> Table:
        rows, size = table.metrics[f"{name}_rows"], table.metrics[f"{name}_bytes"]
        return Table(df, int(rows or 0), int(size or 0), table.path, {})

    return NotableIds(
        sized(table.df.where(is_repeated).select(*scope, "id", "n_same"), "repeated"),
        sized(
            table.df.where(is_lost).select(*scope, "id", "n_wanted", F.lit(True).alias("lost")),
            "lost",
        ),
    )


def attach_ids(
    rows: DataFrame,
    ids: NotableIds,
    scope: list[str],
    own: Column,
    counted: Column,
    wanted: Column,
    spread: Column,
    **limits,
) -> DataFrame:
    """Add ``same_id`` (times the id occurs) and ``orphan`` to every row.

    ``wanted`` is null for rows that refer to nothing and blank for those that
    should but do not.
    """
    here = {name: F.col(name) for name in scope}

    def find_lost(some: DataFrame) -> DataFrame:
        key = {**here, "id": F.when(~is_blank(wanted), wanted)}
        return lookup(some, ids.lost, key, ["lost"], "n_wanted", spread, **limits)

    if ids.lost.rows == 0 or fits_broadcast(ids.lost, **limits):
        out = find_lost(rows)
    else:
        # Only the rows that refer to something go through this shuffle.
        refers = ~is_blank(wanted)
        rest = rows.where(~refers).withColumn("lost", F.lit(None).cast("boolean"))
        out = find_lost(rows.where(refers)).unionByName(rest)

    key = {**here, "id": F.when(counted, own)}
    out = lookup(out, ids.repeated, key, ["n_same"], "n_same", spread, **limits)
    return out.withColumns(
        {
            "same_id": F.coalesce(F.col("n_same"), counted.cast("bigint")),
            "orphan": wanted.isNotNull() & (is_blank(wanted) | F.col("lost").isNotNull()),
        }
    ).drop("n_same", "lost")
