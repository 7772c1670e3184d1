"""Alerts and dead letters, kept per run so that repeating a run adds nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.operators.gate import alerts, dead_letters


def _write_run(df: DataFrame, path: str, run_id: str) -> None:
    (
        df.withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def write_alerts(files: DataFrame, path: str, run_id: str) -> None:
    _write_run(alerts(files), path, run_id)


def write_dead_letters(files: DataFrame, path: str, run_id: str) -> None:
    _write_run(dead_letters(files), path, run_id)
