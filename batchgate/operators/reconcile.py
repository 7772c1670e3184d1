"""Which of the defects put into a batch did validation report?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def manifest_reconcile(manifest: DataFrame, violations_long: DataFrame) -> DataFrame:
    """Manifest entries with ``detected``: some row of the id broke that rule.

    A label need not be detected: flipping the sign of a transfer, for one, is
    no violation.
    """
    found = (
        violations_long.select("transaction_id", F.col("rule").alias("defect"))
        .distinct()
        .withColumn("detected", F.lit(True))
    )
    return manifest.join(found, ["transaction_id", "defect"], "left").select(
        "transaction_id",
        "defect",
        "severity",
        F.coalesce(F.col("detected"), F.lit(False)).alias("detected"),
    )
