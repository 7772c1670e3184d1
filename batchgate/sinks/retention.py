"""Retention of processed output."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate import schema as S
from batchgate.operators.rows import as_of_column
from batchgate.session import materialise, release, spread_files
from batchgate.sinks.batches import SUMMARY
from batchgate.sources.incoming import qualified_uri


def expired_batches(
    batches: DataFrame, as_of: date | str | None = None, days: int = S.RETENTION_DAYS
) -> DataFrame:
    """Batches whose ``finished_at`` day lies more than ``days`` before ``as_of``.

    Output is kept for ``days`` full days and expires at the midnight after.
    """
    age = F.datediff(as_of_column(as_of), F.col("finished_at").cast("date"))
    return batches.where(age > days).withColumn("age_days", age)


def remove_batches(spark: SparkSession, processed: str, expired: DataFrame) -> int:
    """Delete the output of ``expired`` batches by tasks; returns how many were there.

    Repeating it, or a task of it, does no harm: what is gone already is passed over.
    A batch's summary goes first, so that one half removed counts as incomplete.
    """
    uri = qualified_uri(spark, processed.rstrip("/"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(uri)

        def gone(folder: str) -> bool:
            try:
                files.delete_dir(folder)
            except FileNotFoundError:
                return False
            return True

        for rows in batches:
            folders = [f"{root}/batch={b}" for b in rows.column(0).to_pylist()]
            removed = 0
            for folder in folders:
                gone(f"{folder}/object={SUMMARY}")
                removed += gone(folder)
            yield pa.RecordBatch.from_pydict({"removed": pa.array([removed], pa.int64())})

    named = expired.select("partner_batch_id").where("partner_batch_id IS NOT NULL").distinct()
    # Counted first: a listing behind ``expired`` may change while batches go.
    listed = materialise(named, "removing")
    done = spread_files(listed.df, listed.rows, "partner_batch_id").mapInArrow(remove, "removed long")
    removed = done.agg(F.sum("removed")).first()[0] or 0
    release(spark, listed.path)
    return removed
