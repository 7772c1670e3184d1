"""Clean transactions, one per numbered row."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate import schema as S
from batchgate.functions import draw, pick, uniform

# Amounts are log-normal, rounded to cents and clamped.
AMOUNT_MU = 3.2
AMOUNT_SIGMA = 0.9
AMOUNT_LEAST = 0.01
AMOUNT_MOST = 9999.99
ACCOUNTS = 5000
# Days from transaction to posting, with weights.
POSTING_LAGS = {0: 0.6, 1: 0.3, 2: 0.1}

KEY = "row_index"


def row_numbers(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1).withColumnRenamed("id", KEY)


def amount_column(seed: int, kind: Column, status: Column) -> Column:
    """Signed amount: refunds negative, purchases and fees positive, else either."""
    key = F.col(KEY)
    # Normal variate from two uniforms; 1 - u keeps the logarithm finite.
    radius = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - uniform(seed, 2, key, 0)))
    normal = radius * F.cos(F.lit(2.0 * math.pi) * uniform(seed, 2, key, 1))
    size = F.round(F.exp(F.lit(AMOUNT_MU) + F.lit(AMOUNT_SIGMA) * normal), 2)
    size = F.greatest(F.lit(AMOUNT_LEAST), F.least(size, F.lit(AMOUNT_MOST)))
    heads = uniform(seed, 2, key, 2) < 0.5
    negative = kind.isin(S.NEGATIVE_TYPES) | (~kind.isin(S.POSITIVE_TYPES) & ~heads)
    return F.when(status == "failed", F.lit(0.0)).when(negative, -size).otherwise(size)


def clean_rows(
    numbers: DataFrame,
    batch_id: str | Column,
    batch_day: date | str | Column,
    seed: int,
    source_key: str | Column | None = None,
) -> DataFrame:
    """A valid transaction for every ``row_index``; refunds are not linked yet.

    Each value is a function of the seed and the row number alone.
    """
    key = F.col(KEY)
    day = batch_day if isinstance(batch_day, Column) else F.lit(str(batch_day)).cast("date")
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    if source_key is None:
        source_key = F.concat(
            F.lit("incoming/transactions_"), day.cast("string"), F.lit("_"), batch, F.lit(".csv")
        )
    elif not isinstance(source_key, Column):
        source_key = F.lit(source_key)
    drawn = numbers.select(
        source_key.alias("source_key"),
        key,
        batch.alias("partner_batch_id"),
        pick(uniform(seed, 0, key, 0), S.TRANSACTION_TYPES).alias("transaction_type"),
        pick(uniform(seed, 0, key, 1), S.STATUSES).alias("status"),
        pick(uniform(seed, 0, key, 2), S.CURRENCIES).alias("currency"),
        pick(uniform(seed, 0, key, 3), S.MERCHANTS).alias("merchant_name"),
        F.date_sub(day, (draw(seed, 1, key, 0) % 2).cast("int")).alias("txn_day"),
        pick(uniform(seed, 1, key, 1), POSTING_LAGS).alias("lag"),
        (draw(seed, 1, key, 2) % ACCOUNTS + 1).alias("account"),
        pick(uniform(seed, 1, key, 3), S.SOURCE_SYSTEMS).alias("source_system"),
    )
    amount = amount_column(seed, F.col("transaction_type"), F.col("status"))
    values = {
        "transaction_id": F.concat(F.lit("TXN-"), padded(key, 8)),
        "account_id": F.concat(F.lit("ACCT-"), padded(F.col("account"), 6)),
        "transaction_date": F.col("txn_day").cast("string"),
        "posted_date": F.date_add("txn_day", F.col("lag")).cast("string"),
        "amount": F.format_string("%.2f", amount),
        "related_transaction_id": F.lit(""),
    }
    return drawn.select(
        "source_key",
        key.alias("row_seq"),
        *[values.get(c, F.col(c)).alias(c) for c in S.TRANSACTION_COLUMNS],
    )


def padded(number: Column, width: int) -> Column:
    """Digits with leading zeros; a number with more digits keeps them all."""
    return F.format_string(f"%0{width}d", number)
