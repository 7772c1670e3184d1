"""The four-stage workload over CSV files: read, parse, validate, aggregate."""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession

from batchgate import schema as S
from batchgate.operators.workload import (
    bench_by_type,
    bench_ids,
    bench_parse,
    bench_screen,
    bench_settle,
)
from batchgate.session import release
from batchgate.sources.csv_files import read_all_strings

COUNTS = ("total_rows", "passed", "rejected_critical", "flagged_warning_only")

def bench_workload(
    spark: SparkSession,
    path: str | list[str],
    as_of: date | str | None = None,
    schema=S.TRANSACTION_SCHEMA,
) -> dict:
    """Counts over the whole input and rows per transaction type.

    Two passes over the files: one over the id columns alone, one that parses,
    flags and counts. ``schema`` saves the look into the header; pass None if
    the columns of the file are in another order.
    """
    rows = read_all_strings(spark, path, schema)
    ids = bench_ids(rows)
    flagged = bench_settle(bench_screen(bench_parse(rows), as_of), ids)
    result = dict.fromkeys(COUNTS, 0)
    result["by_transaction_type"] = {}
    for row in bench_by_type(flagged).toLocalIterator():
        for name in COUNTS:
            result[name] += row[name]
        result["by_transaction_type"][row.transaction_type] = row.total_rows
    release(spark, *ids.paths)
    return result
