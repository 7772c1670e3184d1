"""Whole sample batches."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate.functions import draw
from batchgate.operators.linkage import link_refunds
from batchgate.session import materialise
from batchgate.synth.clean import clean_rows, row_numbers
from batchgate.synth.defects import inject_defects

_SHUFFLE = 20


def shuffle_rows(rows: DataFrame, seed: int) -> DataFrame:
    """Rows in an order unrelated to ``row_seq``, and numbered as they were."""
    key = F.concat_ws("|", F.col("row_seq").cast("string"), F.col("is_copy").cast("string"))
    return rows.orderBy(draw(seed, _SHUFFLE, key), "row_seq", "is_copy")


def generate_benchmark(
    spark: SparkSession, n: int, seed: int, batch_id: str, batch_day: date | str | None = None
) -> DataFrame:
    """``n`` clean transactions of one batch, refunds linked."""
    clean = clean_rows(row_numbers(spark, n), batch_id, batch_day or date.today(), seed)
    return link_refunds(materialise(clean, "clean").df, seed)


def generate_seeded(
    spark: SparkSession,
    n: int,
    defect_rate: float,
    seed: int,
    batch_id: str,
    batch_day: date | str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """A shuffled batch with known defects, and the manifest of them."""
    linked = materialise(generate_benchmark(spark, n, seed, batch_id, batch_day), "linked")
    rows, manifest = inject_defects(linked.df, defect_rate, seed)
    defective = materialise(rows, "defective").df
    return shuffle_rows(relink(defective, seed), seed), manifest


def relink(rows: DataFrame, seed: int) -> DataFrame:
    """Link refunds that came up after the first linking, copies included."""
    numbered = rows.withColumn(
        "link_seq", F.col("row_seq") * 2 + F.col("is_copy").cast("bigint")
    )
    return link_refunds(numbered, seed, order="link_seq", stream=91).drop("link_seq")
