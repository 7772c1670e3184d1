"""From arriving files to processed batches, all files of a run together.

    listing -> file gate -> line profile -> staged rows -> whole-file rules
            -> transactions, summaries, alerts, dead letters

Files are never handled one after the other: each step is a job over the rows
or the files of the whole run, and what differs per file is a column.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate import schema as S
from batchgate.operators import gate as G
from batchgate.operators.batch import COUNTS, count_columns, validate_batch
from batchgate.operators.lookups import fits_broadcast, lookup
from batchgate.operators.rows import ROW_RULES, RowRule
from batchgate.session import Table, materialise, release
from batchgate.sinks.batches import (
    clear_summaries,
    processed_batches,
    write_summaries,
    write_transactions,
)
from batchgate.sinks import versions
from batchgate.sinks.logs import write_alerts, write_dead_letters
from batchgate.sources.csv_files import (
    Layouts,
    find_layouts,
    overlong_files,
    profile_files,
    read_batch_csv,
    read_records,
)
from batchgate.sources.incoming import list_incoming, mark_found

# Columns a rule reads without a default: (column, count that must be zero).
_NEEDED = [
    ("transaction_type", "n_ok"),
    ("status", "n_ok"),
    ("currency", "n_known_status"),
]


@dataclass(frozen=True)
class RunResult:
    """``files`` has one row per arriving file, with disposition and counts."""

    files: DataFrame
    processed: str
    run_id: str

    def alerts(self) -> DataFrame:
        return G.alerts(self.files)

    def dead_letters(self) -> DataFrame:
        return G.dead_letters(self.files)


def _gate(
    spark: SparkSession,
    files: DataFrame,
    processed: str,
    as_of: date | str | None,
    max_bytes: int,
    stale_days: int,
    versioned: bool,
) -> DataFrame:
    gated = G.gate_files(files, as_of, max_bytes, stale_days)
    earlier = (
        versions.current(spark, processed, gated) if versioned else processed_batches(spark, processed)
    )
    return G.mark_already_processed(gated, earlier)


def _file_counts(rows: DataFrame) -> DataFrame:
    known = F.coalesce(F.col("status").isin(list(S.STATUSES)), F.lit(False))
    return rows.groupBy("source_key").agg(
        *count_columns(),
        F.count_if("ok").alias("n_ok"),
        F.count_if(F.col("ok") & known).alias("n_known_status"),
    )


def _settle(
    files: DataFrame,
    profile: DataFrame,
    counts: DataFrame,
    layouts: Layouts,
    overlong: DataFrame | None,
) -> DataFrame:
    """Dispositions that depend on what the files hold."""
    lacks = {
        name: F.col("layout")[S.TRANSACTION_COLUMNS.index(name)] == -1 for name, _ in _NEEDED
    }
    joined = (
        files.join(profile.select("source_key", "utf8_ok", "n_lines"), "source_key", "left")
        .join(layouts.table.df.select("source_key", "layout"), "source_key", "left")
        .join(counts, "source_key", "left")
    )
    error = None
    if overlong is not None:
        joined = joined.join(overlong.withColumn("__long", F.lit(True)), "source_key", "left")
        error = F.when(F.col("__long"), F.lit(G.REASON_FIELD))
    for name, needed_by in _NEEDED:
        bad = lacks[name] & (F.col(needed_by) > 0)
        text = F.lit(f"no column '{name}'")
        error = F.when(bad, text) if error is None else error.when(bad, text)
    # A file that holds bytes has a line; without one the scan did not find it. An object
    # announced without a size is gone if it is not in the listing.
    gone = F.col("n_lines").isNull() & ((F.col("size_bytes") > 0) | ~F.col("found"))
    error = error.when(gone, F.lit(G.REASON_GONE))
    admitted = F.col("admitted")
    undecodable = admitted & F.coalesce(~F.col("utf8_ok"), F.lit(False))
    settled = joined.withColumn("__error", F.when(admitted & ~undecodable, error)).withColumn(
        "__bad_text", undecodable
    ).withColumns(
        {
            "disposition": F.when(F.col("__bad_text"), G.REJECTED_ENCODING)
            .when(F.col("__error").isNotNull(), G.FAILED)
            .otherwise(F.col("disposition")),
            "reason": F.when(F.col("__bad_text"), G.REASON_ENCODING).otherwise(
                F.coalesce(F.col("__error"), F.col("reason"))
            ),
        }
    )
    accepted = F.col("disposition") == G.ACCEPTED
    counted = {c: F.when(accepted, F.coalesce(F.col(c), F.lit(0))) for c in COUNTS}
    return settled.withColumns(counted).drop(
        "__error", "__bad_text", "__long", "layout", "utf8_ok", "n_ok", "n_known_status", "found"
    )


def _replace_output(
    processed: str,
    winners: DataFrame,
    valid: DataFrame,
    exceptions: DataFrame,
    shared: DataFrame,
    processed_at: Column,
    spread_out: bool,
) -> None:
    """A batch without a summary is not complete: the old one goes before rows are replaced."""
    # Batches without output have no summary that could stand for other rows.
    clear_summaries(winners.where("already_processed"), processed)
    write_transactions(valid, winners, processed, spread_out)
    write_summaries(winners, exceptions, shared, processed, processed_at)


def process_incoming(
    spark: SparkSession,
    root: str,
    as_of: date | str | None = None,
    max_bytes: int = S.MAX_FILE_BYTES,
    stale_days: int = S.STALE_DAYS,
    files: DataFrame | None = None,
    keys: list[str] | None = None,
    run_id: str | None = None,
    run_at: datetime | None = None,
    rules: tuple[RowRule, ...] = ROW_RULES,
    multi_line: bool = False,
    versioned: bool = False,
    **limits,
) -> RunResult:
    """Process the files under ``root``/incoming/ into ``root``/processed/.

    ``files`` replaces the listing: (bucket, source_key, size_bytes,
    arrival_seq), from notification events say; a size of 0 may also mean that the
    notification had none. ``keys`` restricts the run to these files; without it
    all of incoming/ is read.

    ``versioned`` output is committed as a whole (see ``sinks.versions``), and batches
    processed before are looked up in its index. Otherwise output replaces what the
    batches had: summaries go first and are written last.
    """
    root = root.rstrip("/")
    processed = f"{root}/{S.PROCESSED_PREFIX.rstrip('/')}"
    run_id = run_id or uuid.uuid4().hex
    run_at = run_at or datetime.now(timezone.utc)
    scratch: list[str] = []

    def keep(df: DataFrame, name: str, width: Column | None = None, **metrics) -> Table:
        table = materialise(df, name, width, metrics)
        scratch.append(table.path)
        return table

    if files is None:
        listed = list_incoming(spark, root, keys=keys).withColumn("found", F.lit(True))
        if keys is not None:
            named = spark.createDataFrame([(k,) for k in keys], "source_key string").distinct()
            listed = named.join(listed, "source_key", "left").fillna({"size_bytes": 0, "found": False})
            listed = listed.withColumn("bucket", F.lit(root))
        files = listed.withColumn("arrival_seq", F.struct("modified_at", "source_key"))
    else:
        files = mark_found(spark, root, files)
    gated = keep(_gate(spark, files, processed, as_of, max_bytes, stale_days, versioned), "gated")
    admitted = gated.df.where("admitted")

    # Nothing after this point opens a file that failed the gate.
    if gated.rows and keys is not None:
        there = admitted.where("found")
        wanted = {r.source_key for r in there.select("source_key").toLocalIterator()}
        keys = [k for k in keys if k in wanted]
    if keys is not None and not keys:
        rows = spark.createDataFrame(
            [], ", ".join(f"{c} string" for c in [*S.TRANSACTION_COLUMNS, "source_key"])
        ).withColumn("row_seq", F.lit(0).cast("bigint"))
        profile = keep(
            spark.createDataFrame(
                [], "source_key string, utf8_ok boolean, usual_header boolean, "
                "header string, n_lines bigint, quoted_breaks boolean"
            ),
            "profile",
        )
        layouts, records = find_layouts(spark, profile.df), None
    else:
        profile = keep(profile_files(spark, root, max_bytes, keys=keys), "profile")
        records = None if multi_line else read_records(spark, root, profile.df, max_bytes, keys=keys)
        layouts = find_layouts(spark, profile.df.where("utf8_ok"), records=records)
        rows = read_batch_csv(
            spark, root, layouts, max_bytes, keys=keys, multi_line=multi_line, records=records
        )
    scratch.append(layouts.table.path)
    scratch.extend(records.paths if records else [])

    batch = validate_batch(rows, as_of, rules, **limits)
    judged, ids = batch.rows, batch.ids

    counts = keep(_file_counts(judged), "counts")
    overlong = overlong_files(records) if records else None
    settled = _settle(gated.df, profile.df, counts.df, layouts, overlong)
    result = materialise(G.mark_within_run(settled), "files")
    written = (F.col("disposition") == G.ACCEPTED) & ~F.col("superseded")
    winners = result.df.where(written)

    # Only what the gate admitted is published: the scan may also meet files that
    # are in no listing, or that arrived after it.
    size = F.octet_length("source_key")
    published = keep(
        winners.where(F.col("n_lines").isNotNull()).select(
            "source_key", "n_lines", F.lit(True).alias("published")
        ),
        "published",
        size,
    )

    def of_winners(df: DataFrame) -> DataFrame:
        key = {"source_key": F.col("source_key")}
        marked = lookup(df, published, key, ["published"], "n_lines", F.col("row_seq"))
        return marked.where("published").drop("published")

    shuffled = not all(
        fits_broadcast(t, **limits) for t in (ids.repeated, ids.lost)
    ) or not fits_broadcast(published)
    output = (
        winners,
        of_winners(batch.valid_rows()),
        of_winners(batch.exceptions()),
        of_winners(batch.shared_violations()),
        F.lit(run_at.isoformat()),
    )
    if versioned:
        versions.publish(spark, processed, run_id, *output, spread_out=shuffled)
    else:
        _replace_output(processed, *output, spread_out=shuffled)
    write_alerts(result.df, f"{root}/alerts", run_id)
    write_dead_letters(result.df, f"{root}/dead_letters", run_id)
    batch.release()
    release(spark, *scratch)
    return RunResult(result.df, processed, run_id)
