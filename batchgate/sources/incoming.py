"""Arriving files: a listing of the incoming folder, or notification events."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate import schema as S
from batchgate.session import materialise, spread_files


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:/*"


def _folder(spark: SparkSession, root: str) -> str:
    """``root`` as the file system spells it, without scheme and outer slashes."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return re.sub(_SCHEME, "", system.makeQualified(path).toString()).strip("/")


def relative_key(spark: SparkSession, root: str) -> Column:
    """Path of a scanned file below ``root``, which names the file everywhere."""
    base = _folder(spark, root)
    path = F.col("_metadata.file_path")
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    below = F.substr(F.regexp_replace(decoded, _SCHEME, ""), F.lit(len(base) + 2))
    # Evaluated per row, so a path with nothing to decode is merely cut.
    start = F.locate(f"/{base}/", path)
    plain = F.substr(path, start + F.lit(len(base) + 2))
    return F.when(path.contains("%") | (start == 0), below).otherwise(plain)


_LISTED = "path string, folder boolean, size_bytes long, modified_at timestamp"


def qualified_uri(spark: SparkSession, root: str) -> str:
    """``root`` as a URI, with what a URI cannot hold escaped."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return re.sub("^file:/+", "file:///", system.makeQualified(path).toUri().toString())


def _look(uri: str, within: bool):
    """What a task finds at paths, or ``within`` them, by the file system's own listing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, _ = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found = files.get_file_info(fs.FileSelector(path, allow_not_found=True) if within else [path])
                kept = [f for f in found if f.type != fs.FileType.NotFound]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f.path for f in kept], pa.string()),
                        pa.array([f.type == fs.FileType.Directory for f in kept], pa.bool_()),
                        pa.array([f.size or 0 for f in kept], pa.int64()),
                        pa.array([f.mtime for f in kept], pa.timestamp("us", "UTC")),
                    ],
                    names=["path", "folder", "size_bytes", "modified_at"],
                )

    return run


def list_incoming(
    spark: SparkSession,
    root: str,
    prefix: str = S.INCOMING_PREFIX,
    suffix: str = ".csv",
    keys: list[str] | None = None,
) -> DataFrame:
    """(bucket, source_key, size_bytes, modified_at) of every arriving file.

    Tasks list folders by the file system's own listing, one level of folders after
    another, so objects without bytes and those whose names begin with ``_`` or
    ``.`` are among them. No object is opened. ``keys`` lists just these files, if
    they are there.
    """
    from pyarrow import fs

    base = root.rstrip("/")
    uri = qualified_uri(spark, base)
    _, folder = fs.FileSystem.from_uri(uri)
    folder = folder.rstrip("/")
    if keys is not None:
        level = spark.createDataFrame([(f"{folder}/{k}",) for k in keys], "path string")
        found = level.mapInArrow(_look(uri, within=False), _LISTED)
    else:
        level = spark.createDataFrame([(f"{folder}/{prefix.rstrip('/')}",)], "path string")
        found = None
        while True:
            listed = materialise(
                level.mapInArrow(_look(uri, within=True), _LISTED),
                "listing",
                metrics={"folders": F.count_if("folder")},
            )
            found = listed.df if found is None else found.unionByName(listed.df)
            if not listed.metrics["folders"]:
                break
            folders = listed.df.where("folder").select("path")
            level = spread_files(folders, listed.metrics["folders"], "path")
    return found.where(~F.col("folder") & F.col("path").endswith(suffix)).select(
        F.lit(base).alias("bucket"),
        F.substr("path", F.lit(len(folder) + 2)).alias("source_key"),
        "size_bytes",
        "modified_at",
    )


def mark_found(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """Add ``found``: the object has bytes, or it is in the listing of ``root``.

    Only objects of size 0, and notifications without a size, have to be looked up.
    """
    unsure = F.coalesce(F.col("size_bytes"), F.lit(0)) <= 0
    if files.where(unsure).isEmpty():
        return files.withColumn("found", F.lit(True))
    listed = list_incoming(spark, root).select(
        F.col("source_key").alias("__key"), F.lit(True).alias("__listed")
    )
    looked_up = files.where(unsure).join(listed, F.col("source_key") == F.col("__key"), "left")
    return files.where(~unsure).withColumn("found", F.lit(True)).unionByName(
        looked_up.withColumn("found", F.col("__listed").isNotNull()).drop("__key", "__listed")
    )


def explode_events(events: DataFrame, json_column: str = "event_json") -> DataFrame:
    """(bucket, source_key, size_bytes) for every record of notification events.

    Other columns of ``events`` are kept. ``position`` is the record's place
    within its event.
    """
    keep = [c for c in events.columns if c != json_column]
    parsed = events.select(*keep, F.from_json(json_column, S.EVENT_DDL).alias("__event"))
    records = parsed.select(*keep, F.posexplode("__event.Records").alias("position", "__record"))
    return records.select(
        *keep,
        "position",
        F.col("__record.s3.bucket.name").alias("bucket"),
        F.col("__record.s3.object.key").alias("source_key"),
        F.coalesce(F.col("__record.s3.object.size"), F.lit(0)).alias("size_bytes"),
    )
