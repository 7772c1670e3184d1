"""Exact dedup: group by a 128-bit content hash, keep the smallest id, compare bytes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import bounded, materialise

# Runs of white space that are not one space already.
UNEVEN_SPACE = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"


def normalised(text: Column) -> Column:
    """Null as empty, every run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), UNEVEN_SPACE, " ")


def mark_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    content_key: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Equal normalised texts form a group; its row with the smallest id stays.
    Ids that are null come last; of rows that share the smallest id one stays.
    Null text is empty text, and empty texts are equal. An empty table gives an
    empty result. Other columns, whatever their names, play no part.

    Rows are counted per 128-bit key first, so only texts whose key repeats are
    moved. They are compared byte for byte with the first text of their key;
    texts that differ from it are grouped by the text itself.
    """
    marked = _marked(docs, [], id_col, text_col, content_key)
    return marked.select(
        F.col("_id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256"
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged."""
    marked = _marked(docs, docs.columns, id_col, text_col, F.md5)
    return marked.where("kept").select(*[F.col("_carry")[c].alias(c) for c in docs.columns])


def _marked(docs, carry, id_col, text_col, content_key) -> DataFrame:
    text = normalised(F.col(text_col))
    repeated = materialise(
        docs.select(content_key(text).alias("_key")).groupBy("_key").count().where("count > 1"),
        "repeated-keys",
        F.lit(48),
    )
    rows = materialise(
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            F.col(id_col).alias("_id"),
            (F.struct(*[docs[c] for c in carry]) if carry else F.lit(0)).alias("_carry"),
            text.alias("_text"),
        )
        .withColumn("_key", content_key(F.col("_text")))
        .withColumn("text_sha256", F.sha2("_text", 256))
        .join(bounded(repeated), "_key", "left")
        .select(
            "_row", "_id", "_carry", "_key", "text_sha256",
            F.when(F.col("count").isNotNull(), F.col("_text")).alias("_text"),
        ),
        "keyed-texts",
    )
    order = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_row").alias("r"))
    members = rows.df.where(F.col("_text").isNotNull())
    first = materialise(
        members.groupBy("_key").agg(F.min_by("_text", order).alias("_first")), "first-texts"
    )
    # `_other` is null for texts equal to the first of their key, else the text itself.
    compared = materialise(
        members.join(first.df, "_key").select(
            "_row", "_id", "_carry", "_key", "text_sha256",
            F.when(F.col("_text") != F.col("_first"), F.col("_text")).alias("_other"),
        ),
        "compared-texts",
    )
    groups = materialise(
        compared.df.groupBy("_key", "_other").agg(
            F.min(order).alias("_best"), F.count(F.lit(1)).alias("group_size")
        ),
        "copy-groups",
        128 + F.coalesce(F.octet_length("_other"), F.lit(0)),
    )
    found = compared.df.alias("c").join(
        bounded(groups).alias("g"),
        (F.col("c._key") == F.col("g._key")) & F.col("c._other").eqNullSafe(F.col("g._other")),
    )
    copies = found.select(
        "_id",
        "_carry",
        F.col("_best.i").alias("keep_id"),
        "group_size",
        (F.col("_best.r") == F.col("_row")).alias("kept"),
        "text_sha256",
    )
    alone = rows.df.where(F.col("_text").isNull()).select(
        "_id",
        "_carry",
        F.col("_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    return alone.unionByName(copies)
