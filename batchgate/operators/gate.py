"""File gate: which arriving files are read, and what is said about them.

Everything here works on one row per file. Only the name, the size and the
listing of earlier output are consulted, so no file is opened.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate import schema as S
from batchgate.functions import parse_iso_date
from batchgate.operators.lookups import lookup
from batchgate.operators.rows import as_of_column
from batchgate.session import materialise

# Fixed value: the file name convention (date, then batch id without "_").
FILENAME_PATTERN = r"(?d)^transactions_(\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2})_([A-Za-z0-9\-]+)\.csv$"

REJECTED_FILENAME = "rejected_filename"
REJECTED_SIZE = "rejected_size"
REJECTED_ENCODING = "rejected_encoding"
FAILED = "failed"
ACCEPTED = "accepted"

# Alert subjects, messages and rejection reasons.
REJECTED_SUBJECT = "Transaction Pipeline: Rejected File"
REPROCESSING_SUBJECT = "Transaction Pipeline: Reprocessing Detected"
REJECTED_MESSAGE = (
    "A file was rejected: %s\n\n"
    "Bucket: %s\n"
    "Key: %s\n\n"
    "The file has been left in place. Review it manually in the AWS "
    "Console and rename, move, or delete it as appropriate."
)
REPROCESSING_MESSAGE = (
    "A file was received for a batch that has already been processed. "
    "The previous result will be overwritten.\n\n"
    "Bucket: %s\n"
    "Key: %s\n"
    "Partner batch ID: %s\n\n"
    "No action is required unless this reprocessing was unexpected."
)
REASON_FILENAME = "filename does not match the expected convention"
REASON_SIZE = "file size (%s bytes) exceeds the %s-byte limit for a daily file"
REASON_ENCODING = "file could not be decoded as UTF-8"

REASON_NO_KEY = "notification names no object"
REASON_GONE = "object is missing or cannot be read"
REASON_FIELD = "field larger than field limit (131072)"


def file_name(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def name_matches(name: Column) -> Column:
    return name.rlike(FILENAME_PATTERN)


def parse_filename(key: Column) -> tuple[Column, Column]:
    """(file date text, batch id), both null when the name is not conventional."""
    name = file_name(key)
    ok = name_matches(name)
    return tuple(F.when(ok, F.regexp_extract(name, FILENAME_PATTERN, i)) for i in (1, 2))


def too_large(size: Column, max_bytes: int = S.MAX_FILE_BYTES) -> Column:
    return size > F.lit(max_bytes)


def staleness(file_date: Column, as_of: Column, days: int = S.STALE_DAYS) -> Column:
    """Warning text for a file date further than ``days`` from ``as_of``, else null."""
    age = F.datediff(as_of, parse_iso_date(file_date))

    def text(n: Column, side: str) -> Column:
        return F.concat(
            F.lit("Filename date "), file_date, F.lit(" is "), n.cast("string"), F.lit(side)
        )

    return F.when(age > days, text(age, " days in the past")).when(
        age < -days, text(-age, " days in the future")
    )


def gate_files(
    files: DataFrame,
    as_of: date | str | None = None,
    max_bytes: int = S.MAX_FILE_BYTES,
    stale_days: int = S.STALE_DAYS,
) -> DataFrame:
    """Judge each file by ``source_key`` and ``size_bytes``.

    Adds ``file_date``, ``partner_batch_id``, ``disposition`` (the first of
    name, size and calendar date that fails, or accepted; a record without a
    key is a failure of its own), ``reason``,
    ``admitted`` (the file goes on to be read) and, for those, ``staleness``.
    """
    day = as_of_column(as_of)
    file_date, batch = parse_filename(F.col("source_key"))
    named = files.withColumns({"file_date": file_date, "partner_batch_id": batch})
    large = too_large(F.col("size_bytes"), max_bytes)
    no_day = parse_iso_date(F.col("file_date")).isNull()
    no_key = F.col("source_key").isNull()
    judged = named.withColumn(
        "disposition",
        F.when(no_key, FAILED)
        .when(F.col("partner_batch_id").isNull(), REJECTED_FILENAME)
        .when(large, REJECTED_SIZE)
        .when(no_day, FAILED)
        .otherwise(ACCEPTED),
    )
    disposition = F.col("disposition")
    return judged.withColumns(
        {
            "reason": F.when(no_key, REASON_NO_KEY)
            .when(disposition == REJECTED_FILENAME, REASON_FILENAME)
            .when(
                disposition == REJECTED_SIZE,
                F.format_string(REASON_SIZE, "size_bytes", F.lit(str(max_bytes))),
            )
            .when(
                disposition == FAILED,
                F.concat(F.lit("file date '"), F.col("file_date"), F.lit("' is not a date")),
            ),
            "admitted": disposition == ACCEPTED,
            "staleness": F.when(
                disposition == ACCEPTED, staleness(F.col("file_date"), day, stale_days)
            ),
        }
    )


def mark_already_processed(files: DataFrame, processed: DataFrame) -> DataFrame:
    """Add ``already_processed``: the batch has output from an earlier run.

    ``processed`` has a ``partner_batch_id`` column; it may repeat ids.
    """
    arriving = files.groupBy("partner_batch_id").agg(F.count(F.lit(1)).alias("n_files"))
    seen = arriving.join(
        processed.select("partner_batch_id").distinct(), "partner_batch_id"
    ).withColumn("seen", F.lit(True))
    table = materialise(seen, "processed", F.octet_length("partner_batch_id"))
    out = lookup(
        files,
        table,
        {"partner_batch_id": F.col("partner_batch_id")},
        ["seen"],
        "n_files",
        F.col("source_key"),
    )
    return out.withColumn("already_processed", F.coalesce(F.col("seen"), F.lit(False))).drop("seen")


def mark_within_run(files: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """Tell apart several files of one batch in one run.

    ``reprocessing``: output of the batch exists when this file arrives, be it
    from an earlier run or from an earlier accepted file of this run. It holds
    for every file that passed the gate, whatever its content turns out to be.
    ``superseded``: a later accepted file of the run replaces this one's output.
    First and last arrival per batch are a partial aggregation; no batch is
    gathered or ordered as a whole.
    """
    accepted = F.col("disposition") == ACCEPTED
    arrived = F.when(accepted, F.col(order))
    spans = (
        files.where("admitted")
        .groupBy("partner_batch_id")
        .agg(
            F.min(arrived).alias("first_seq"),
            F.max(arrived).alias("last_seq"),
            F.count(F.lit(1)).alias("n_files"),
        )
        .where((F.col("n_files") > 1) & F.col("first_seq").isNotNull())
    )
    table = materialise(spans, "spans", F.octet_length("partner_batch_id"))
    out = lookup(
        files,
        table,
        {"partner_batch_id": F.col("partner_batch_id")},
        ["first_seq", "last_seq"],
        "n_files",
        F.col("source_key"),
    )
    again = F.col("already_processed") | (F.col(order) > F.col("first_seq"))
    return out.withColumns(
        {
            "reprocessing": F.col("admitted") & F.coalesce(again, F.lit(False)),
            "superseded": accepted
            & F.coalesce(F.col(order) < F.col("last_seq"), F.lit(False)),
        }
    ).drop("first_seq", "last_seq")


def alerts(files: DataFrame) -> DataFrame:
    """One row per alert; a file can raise both kinds, reprocessing first."""
    bucket, key = F.col("bucket"), F.col("source_key")
    again = F.struct(
        F.lit(REPROCESSING_SUBJECT).alias("subject"),
        F.format_string(REPROCESSING_MESSAGE, bucket, key, F.col("partner_batch_id")).alias(
            "message"
        ),
    )
    rejected = F.struct(
        F.lit(REJECTED_SUBJECT).alias("subject"),
        F.format_string(REJECTED_MESSAGE, F.col("reason"), bucket, key).alias("message"),
    )
    raised = F.array_compact(
        F.array(
            F.when(F.col("reprocessing"), again),
            F.when(F.col("disposition").startswith("rejected_"), rejected),
        )
    )
    return files.select("bucket", "source_key", F.explode(raised).alias("a")).select(
        "bucket", "source_key", "a.subject", "a.message"
    )


def dead_letters(files: DataFrame) -> DataFrame:
    """Files that could not be handled, with the error; the others go on."""
    return files.where(F.col("disposition") == FAILED).select(
        "bucket", "source_key", "size_bytes", F.col("reason").alias("error")
    )
