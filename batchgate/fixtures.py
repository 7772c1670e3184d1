"""Transaction rows and a file listing derived from the driver's tables.

Deterministic arithmetic over ``events`` and ``documents``: the same rows come
out of any engine, which lets each query be checked against plain SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate.session import materialise
from batchgate.synth.clean import padded

AS_OF = "2024-02-15"
FILE_DAY = "2024-02-14"
ROWS_PER_FILE = 500
FIXTURE_MAX_BYTES = 10_000


def _when(*cases: tuple[Column, str | Column], otherwise) -> Column:
    out = None
    for condition, value in cases:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(otherwise)


def transactions_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per event, 500 events to a file, defects by row number."""
    k = F.col("event_id")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    base = events.select(
        k.alias("row_seq"),
        F.floor(k / ROWS_PER_FILE).alias("b"),
        "user_id",
        "event_type",
        "value",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )
    k = F.col("row_seq")
    batch = F.concat(F.lit("BATCH-"), padded(F.col("b"), 4))

    def txn(n: Column) -> Column:
        return F.concat(F.lit("TXN-"), padded(n, 8))

    kind = _when(
        (F.col("event_type") == "purchase", "purchase"),
        (F.col("event_type") == "click", "refund"),
        (F.col("event_type") == "view", "transfer"),
        (F.col("event_type") == "signup", "adjustment"),
        otherwise="fee",
    )
    typed = base.withColumn("transaction_type", kind)
    is_refund = F.col("transaction_type") == "refund"
    either = F.col("transaction_type").isin("transfer", "adjustment")
    negative = (is_refund | (either & (k % 2 == 0))) != (k % 59 == 1)
    money = F.when(negative, -F.col("value")).otherwise(F.col("value"))
    future = k % 109 == 13
    return typed.select(
        F.concat(F.lit(f"incoming/transactions_{FILE_DAY}_"), batch, F.lit(".csv")).alias(
            "source_key"
        ),
        "row_seq",
        txn(F.when(k % 97 == 5, k - 1).otherwise(k)).alias("transaction_id"),
        batch.alias("partner_batch_id"),
        F.when(k % 101 == 7, "")
        .otherwise(F.concat(F.lit("ACCT-"), padded(F.col("user_id"), 6)))
        .alias("account_id"),
        _when(
            (k % 103 == 9, ""),
            (k % 107 == 11, "not-a-date"),
            (future, "2999-01-01"),
            otherwise=F.col("day"),
        ).alias("transaction_date"),
        _when(
            (k % 127 == 17, ""),
            (future, "2999-01-02"),
            (k % 113 == 15, "2023-12-31"),
            otherwise="2024-02-01",
        ).alias("posted_date"),
        "transaction_type",
        _when(
            (k % 137 == 21, ""),
            (k % 131 == 19, "not-a-number"),
            ((k % 53 == 3) | ((k % 31 == 0) & (k % 62 != 0)), "0.00"),
            otherwise=money.cast("decimal(12,2)").cast("string"),
        ).alias("amount"),
        _when(
            (k % 61 == 2, "XXX"), (k % 20 < 17, "USD"), (k % 20 < 19, "CAD"), otherwise="EUR"
        ).alias("currency"),
        _when(
            (k % 67 == 4, "unknown_status"),
            (k % 31 == 0, "failed"),
            (k % 19 == 0, "pending"),
            (k % 47 == 0, "reversed"),
            otherwise="completed",
        ).alias("status"),
        F.concat(F.lit("Merchant "), (k % 12).cast("string")).alias("merchant_name"),
        _when(
            (~is_refund, ""),
            (k % 73 == 8, ""),
            (k % 71 == 6, "TXN-99999999"),
            otherwise=txn(F.col("b") * ROWS_PER_FILE + (k * 7 + 1) % ROWS_PER_FILE),
        ).alias("related_transaction_id"),
        F.concat(F.lit("SYS-"), (k % 4).cast("string")).alias("source_system"),
    )


def listing_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One arriving file per document, ``size_bytes`` its text length."""
    d = F.col("doc_id")
    batch = F.concat(F.lit("BATCH-"), F.when(d % 13 == 5, d - 1).otherwise(d).cast("string"))
    day = F.lpad((1 + d % 28).cast("string"), 2, "0")
    key = _when(
        (
            d % 11 == 3,
            F.concat(F.lit("incoming/not_a_valid_filename_"), d.cast("string"), F.lit(".csv")),
        ),
        (
            d % 29 == 7,
            F.concat(
                F.lit("incoming/transactions_2024-13-45_BATCH-"), d.cast("string"), F.lit(".csv")
            ),
        ),
        otherwise=F.concat(
            F.lit("incoming/transactions_2024-02-"), day, F.lit("_"), batch, F.lit(".csv")
        ),
    )
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        d.alias("arrival_seq"),
        key.alias("source_key"),
        F.col("n_chars").alias("size_bytes"),
        (d % 17 == 2).alias("already_processed"),
    )


_landed: dict[tuple[str, str, str], str] = {}


def _land(spark: SparkSession, sf_dir: str, name: str, view, key: str) -> DataFrame:
    """A view written once per application, the way an arriving batch is staged."""
    which = (spark.sparkContext.applicationId, sf_dir, name)
    if which not in _landed:
        parts = spark.sparkContext.defaultParallelism
        _landed[which] = materialise(view(spark, sf_dir).repartition(parts, key), name).path
    return spark.read.parquet(_landed[which])


def landed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _land(spark, sf_dir, "transactions", transactions_view, "source_key")


def landed_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _land(spark, sf_dir, "listing", listing_view, "arrival_seq")
