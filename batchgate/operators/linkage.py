"""Dense numbering within files, and the links it makes possible."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchgate.functions import draw_below
from batchgate.operators.lookups import lookup
from batchgate.session import materialise

BLOCK_BITS = 16


def dense_index(rows: DataFrame, scope: list[str], order: str, name: str) -> DataFrame:
    """Number the rows of each scope from 1 without gaps, in ``order``.

    ``order`` is a non-negative integer, unique within the scope. Rows are
    numbered within blocks of at most 2^16 neighbouring positions, and a block
    starts where the blocks before it end: no task ever holds more than a
    block, however large one scope is.
    """
    block = F.shiftright(F.col(order), BLOCK_BITS)
    blocked = rows.withColumn("__block", block)
    sizes = blocked.groupBy(*scope, "__block").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*scope).orderBy("__block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        *scope, "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    within = F.row_number().over(Window.partitionBy(*scope, "__block").orderBy(order))
    return (
        blocked.withColumn("__within", within)
        .join(offsets, [*scope, "__block"])
        .withColumn(name, F.col("__within") + F.col("__offset"))
        .drop("__block", "__within", "__offset")
    )


def link_refunds(
    rows: DataFrame,
    seed: int,
    scope: list[str] = ["source_key"],
    order: str = "row_seq",
    stream: int = 90,
) -> DataFrame:
    """Point each unlinked refund at a random row of its file that is no refund.

    Refunds that already refer to something keep it; a file without any other
    row leaves them as they are. Every candidate is equally likely.
    """
    is_refund = F.coalesce(F.col("transaction_type") == "refund", F.lit(False))
    unlinked = is_refund & (F.coalesce(F.col("related_transaction_id"), F.lit("")) == "")
    pool = dense_index(
        rows.where(~is_refund).select(*scope, order, "transaction_id"), scope, order, "rank"
    ).select(*scope, "rank", F.col("transaction_id").alias("__target"))

    sizes = rows.groupBy(*scope).agg(
        F.count_if(~is_refund).alias("pool_size"), F.count_if(unlinked).alias("n_unlinked")
    )
    width = F.lit(16)
    for name in scope:
        width = width + F.octet_length(F.col(name).cast("string"))
    table = materialise(sizes.where("n_unlinked > 0 and pool_size > 0"), "pools", width)

    waiting = lookup(
        rows.where(unlinked),
        table,
        {name: F.col(name) for name in scope},
        ["pool_size"],
        "n_unlinked",
        F.col(order),
    )
    key: Column = F.concat_ws("|", *[F.col(c).cast("string") for c in [*scope, order]])
    # A refund with no pool draws rank null, which matches nothing.
    chosen = waiting.withColumn(
        "rank",
        F.when(F.col("pool_size") > 0, draw_below(F.col("pool_size"), seed, stream, key) + 1),
    )
    spread = F.coalesce(F.col("rank"), -F.col(order) - 1)
    linked = (
        chosen.withColumn("rank", spread)
        .join(pool, [*scope, "rank"], "left")
        .withColumn(
            "related_transaction_id",
            F.coalesce(F.col("__target"), F.col("related_transaction_id")),
        )
        .select(*rows.columns)
    )
    return linked.unionByName(rows.where(~unlinked))
