"""Defect manifests: which defect was put into which transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate import schema as S


def read_manifest(spark: SparkSession, path: str, one_document: bool = False) -> DataFrame:
    """(transaction_id, defect, severity).

    A manifest is read line by line, one entry per line, as ``write_manifest``
    leaves it. ``one_document`` reads the single JSON object keyed by id
    instead; such a document is held by one task, so it suits samples only.
    """
    if one_document:
        text = spark.read.text(path, wholetext=True)
        entries = F.explode(F.from_json("value", S.MANIFEST_DDL)).alias("transaction_id", "entry")
        return text.select(entries).select("transaction_id", "entry.defect", "entry.severity")
    return spark.read.schema("transaction_id string, defect string, severity string").json(path)
