"""Session settings and the scratch tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings the results depend on, whatever the cluster's own defaults are.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # What the JVM would not compile is better left to smaller pieces of code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "batchgate", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SESSION_SETTINGS, "spark.ui.enabled": "false", **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a private one only on local masters."""
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="batchgate-scratch-"))
    return sc.getCheckpointDir().rstrip("/")


@dataclass(frozen=True)
class Table:
    """A written table with the size that was observed while writing it."""

    df: DataFrame
    rows: int
    bytes: int
    path: str
    metrics: dict


# Spark then removes the shuffle files of a query when it ends, not when the driver happens to
# collect its garbage. What reads a scratch table never goes back to the query that wrote it.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Paths of scratch tables that this process has written and not released, oldest first.
_kept: dict[str, None] = {}


def kept_tables() -> list[str]:
    """Scratch tables that have not been released, mostly those that results read lazily."""
    return list(_kept)


def materialise(
    df: DataFrame,
    name: str,
    width: Column | None = None,
    metrics: dict[str, Column] | None = None,
    codec: str | None = None,
) -> Table:
    """Write ``df`` once to the scratch folder and read it back.

    Row count, estimated in-memory bytes (``width`` summed over the rows, plus
    a fixed overhead) and any extra ``metrics`` are observed by the same job,
    so asking for the size costs no second pass. ``codec`` names another Parquet
    compression than the session's. Shuffle files go when the table is written.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _kept[path] = None
    seen = Observation()
    observed = {
        "rows": F.count(F.lit(1)),
        "bytes": F.sum(width if width is not None else F.lit(0)),
        **(metrics or {}),
    }
    former = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        (
            df.observe(seen, *[c.alias(n) for n, c in observed.items()])
            .write.mode("overwrite")
            .parquet(path, compression=codec)
        )
    finally:
        spark.conf.unset(_CLEANUP) if former is None else spark.conf.set(_CLEANUP, former)
    got = seen.get
    rows = int(got["rows"] or 0)
    return Table(
        df=spark.read.schema(df.schema).parquet(path),
        rows=rows,
        bytes=int(got["bytes"] or 0) + 48 * rows,
        path=path,
        metrics={n: got[n] for n in (metrics or {})},
    )


FILES_AT_ONCE = 100


def spread_files(df: DataFrame, files: int, *by: str) -> DataFrame:
    """``df`` in as many tasks as its ``files`` files, or folders, call for.

    What costs time is every file, not its bytes: adaptive execution, which goes by
    bytes, would leave thousands of small ones to one task. A given number stays.
    """
    return df.repartition(max(-(-files // FILES_AT_ONCE), 1), *by)


def release(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables once nothing reads them any more."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in filter(None, paths):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(hadoop).delete(target, True)
        _kept.pop(path, None)
