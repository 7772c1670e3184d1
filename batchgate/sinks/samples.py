"""Generated samples: transactions as CSV, defect manifests as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from batchgate import schema as S
from batchgate.sinks.batches import CSV_OUT


def write_csv(rows: DataFrame, path: str) -> None:
    """The twelve columns under a header; other columns are dropped."""
    rows.select(*S.TRANSACTION_COLUMNS).write.mode("overwrite").options(
        header="true", **CSV_OUT
    ).csv(path)


def write_manifest(manifest: DataFrame, path: str) -> None:
    """One entry per line, sorted by id across the part files."""
    manifest.select("transaction_id", "defect", "severity").orderBy("transaction_id").write.mode(
        "overwrite"
    ).json(path)
