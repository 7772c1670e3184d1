"""Output of a run: per batch its passing rows, then its summary.

    processed/batch=<batch id>/object=transactions.csv/part-*
    processed/batch=<batch id>/object=summary.json/part-*

All batches of a run are written by one job per object, and only the batches
of the run are replaced. The summary is written last, so a batch that has one
is complete.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from batchgate import schema as S
from batchgate.operators.batch import COUNTS
from batchgate.operators.gate import parse_filename
from batchgate.session import spread_files
from batchgate.sources.incoming import list_incoming, qualified_uri

CSV_OUT = {
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "lineSep": "\r\n",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
TRANSACTIONS = "transactions.csv"
SUMMARY = "summary.json"

# Parts of a summary, in order.
_HEAD, _EXCEPTIONS, _BETWEEN, _SHARED, _END = range(5)


def _batch_of(key: Column) -> Column:
    return parse_filename(key)[1]


def _make_folders(files: DataFrame, processed: str) -> None:
    """Folders of the batches of ``files``, made by tasks.

    A commit that replaces makes the missing ones, too, but one after the other on the driver.
    """
    uri = qualified_uri(files.sparkSession, processed)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(uri)
        for rows in batches:
            for batch in rows.column(0).to_pylist():
                system.create_dir(f"{root}/batch={batch}")
            yield pa.RecordBatch.from_pydict({"made": pa.array([rows.num_rows], pa.int64())})

    # Ids hold letters, digits and hyphens: nothing a path would escape.
    named = files.select(_batch_of(F.col("source_key")).alias("batch")).where("batch IS NOT NULL")
    spread_files(named, files.count(), "batch").mapInArrow(make, "made long").agg(F.sum("made")).collect()


def _replace(
    df: DataFrame, files: DataFrame, processed: str, kind: str, fmt: str, fresh: bool = False, **options
) -> None:
    """Write ``df`` in place of the same object of exactly the batches it has, which ``files`` lists.

    A ``fresh`` folder has nothing to be replaced: output is added, committed as a whole.
    """
    writer = df.withColumn("object", F.lit(kind)).write.format(fmt).options(**options)
    if fresh:
        writer = writer.mode("append")
    else:
        _make_folders(files, processed)
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch", "object").save(processed)


def write_transactions(
    valid: DataFrame, files: DataFrame, processed: str, spread_out: bool = False, fresh: bool = False
) -> None:
    """Passing rows per batch; a file without any leaves just the header line.

    ``files`` has ``source_key`` and ``passed`` of every file to be written.
    Rows that come straight from a scan lie together by file and are written
    where they are. Rows that went through a shuffle (``spread_out``) are first
    ranged by batch and position, which also cuts a very large batch into
    several consecutive parts. ``fresh``: ``processed`` has no transactions yet.
    """
    rows = valid.select(
        _batch_of(F.col("source_key")).alias("batch"), "row_seq", *S.TRANSACTION_COLUMNS
    )
    if spread_out:
        rows = rows.repartitionByRange("batch", "row_seq")
    rows = rows.sortWithinPartitions("batch", "row_seq").drop("row_seq")
    _replace(rows, files, processed, TRANSACTIONS, "csv", fresh, header="true", **CSV_OUT)

    titles = [F.lit(c).alias(c) for c in S.TRANSACTION_COLUMNS]
    bare = files.where(F.col("passed") == 0)
    empty = bare.select(_batch_of(F.col("source_key")).alias("batch"), *titles)
    empty = spread_files(empty, bare.count(), "batch")
    _replace(empty, bare, processed, TRANSACTIONS, "csv", fresh, header="false", **CSV_OUT)


def summary_lines(
    files: DataFrame, exceptions: DataFrame, shared: DataFrame, processed_at: Column
) -> DataFrame:
    """(batch, value): the lines of each file's summary, a JSON document, in order.

    ``files`` has ``source_key`` and the counts. Each exception is a line, and so is
    each entry that the rows of a repeated id share. The lines of a batch are
    numbered by a window, which spills; nothing is gathered into one value.
    """
    head = F.to_json(
        F.struct(
            _batch_of(F.col("source_key")).alias("partner_batch_id"),
            "source_key",
            processed_at.alias("processed_at"),
            F.struct(*COUNTS).alias("counts"),
        )
    )
    found = F.struct("transaction_id", "violations", F.when(F.col("shared"), True).alias("shared"))
    common = F.struct("transaction_id", "row_seq", "rule", "severity", "detail")
    none = F.lit(None)

    def lines(df: DataFrame, part: int, value: Column, ok: Column, row_seq: Column) -> DataFrame:
        return df.select(
            _batch_of(F.col("source_key")).alias("batch"),
            F.lit(part).alias("part"),
            ok.cast("boolean").alias("ok"),
            row_seq.cast("bigint").alias("row_seq"),
            value.alias("value"),
        )

    opened = F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"exceptions":['))
    every = (
        lines(files, _HEAD, opened, none, none)
        .union(lines(exceptions, _EXCEPTIONS, F.to_json(found), F.col("ok"), F.col("row_seq")))
        .union(lines(files, _BETWEEN, F.lit('],"shared_violations":['), none, none))
        .union(lines(shared, _SHARED, F.to_json(common), none, F.col("row_seq")))
        .union(lines(files, _END, F.lit("]}"), none, none))
    )
    every = spread_files(every, files.count(), "batch")
    order = Window.partitionBy("batch").orderBy("part", "ok", "row_seq")
    follows = F.lag("part").over(order) == F.col("part")
    return every.select(
        "batch",
        F.row_number().over(order).alias("n"),
        F.when(follows, F.concat(F.lit(","), "value")).otherwise(F.col("value")).alias("value"),
    ).sortWithinPartitions("batch", "n").select("batch", "value")


def write_summaries(
    files: DataFrame,
    exceptions: DataFrame,
    shared: DataFrame,
    processed: str,
    processed_at: Column,
    fresh: bool = False,
) -> None:
    """Summaries of all files, one document per batch whatever its size.

    ``fresh``: ``processed`` has no summaries yet.
    """
    lines = summary_lines(files, exceptions, shared, processed_at)
    _replace(lines, files, processed, SUMMARY, "text", fresh)


def clear_summaries(files: DataFrame, processed: str) -> None:
    """Empty the summaries of the batches of ``files``, so that none stands for other rows."""
    blank = files.select(_batch_of(F.col("source_key")).alias("batch"), F.lit("").alias("value"))
    blank = spread_files(blank, files.count(), "batch").distinct()
    _replace(blank, files, processed, SUMMARY, "text", lineSep=" ")


def list_objects(spark: SparkSession, folder: str) -> DataFrame:
    """(source_key, size_bytes, modified_at) below ``folder``, listed by tasks; no rows if it is not there.

    Keys begin with the folder's own name. What scans pass over, names with ``_`` or ``.``
    in front and all below them, is left out.
    """
    root, _, name = folder.rstrip("/").rpartition("/")
    listed = list_incoming(spark, root, prefix=f"{name}/", suffix="")
    return listed.where(~F.col("source_key").rlike("/[_.]")).drop("bucket")


def processed_batches(spark: SparkSession, processed: str) -> DataFrame:
    """(partner_batch_id, finished_at) of every batch with output, from the listing.

    ``finished_at`` is null while a batch has rows but no summary yet, or a blank one.
    """
    path = F.col("source_key")
    objects = list_objects(spark, processed).select(
        F.regexp_extract(path, "/batch=([^/]+)/object=", 1).alias("partner_batch_id"),
        F.when(
            path.contains(f"/object={SUMMARY}/") & (F.col("size_bytes") > 1), F.col("modified_at")
        ).alias("at"),
    )
    return (
        objects.where(F.col("partner_batch_id") != "")
        .groupBy("partner_batch_id")
        .agg(F.max("at").alias("finished_at"))
    )
