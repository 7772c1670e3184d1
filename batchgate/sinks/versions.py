"""Versions of batches: data that is never changed, and a log that says what counts.

    data/version=<v>/batch=<batch id>/object=<kind>/part-*   output of one run
    log/index-<v>/slot=<s>/part-*                             batches of a commit, by hash of their id
    log/entry-<n>.json                                        one per commit, numbered

A run writes its data, then the index of its batches, and last its log entry, by a
rename that fails if the number is taken. So readers, who go through the log, see
all batches of a run or none of them: a run that ends anywhere before leaves the
former versions as they were, whole. Two runs at once commit one after the other.

The index is what tells whether a batch was processed before: only the slots of the
ids in question are read, and no data folder is listed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate.session import materialise, release, spread_files
from batchgate.sinks.batches import SUMMARY, TRANSACTIONS, list_objects, write_summaries, write_transactions
from batchgate.sources.incoming import qualified_uri

SLOTS = 64
# After so many entries a commit also writes the index of everything up to it.
COMPACT_AFTER = 20

_POINTER = "partner_batch_id string, version string, source_key string, finished_at timestamp"
_COLUMNS = ["partner_batch_id", "version", "source_key", "finished_at"]


def _slot(batch: Column) -> Column:
    return F.pmod(F.xxhash64(batch), F.lit(SLOTS)).cast("int")


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


@dataclass(frozen=True)
class Entry:
    """A commit: its number, its index, and whether that holds everything before as well."""

    number: int
    index: str
    full: bool
    run_id: str


def entries(spark: SparkSession, processed: str) -> list[Entry]:
    """The entries to be read, oldest first: from the last full one on."""
    files = _file_system(spark, processed)
    found = files.globStatus(_path(spark, f"{processed}/log/entry-*.json"))
    numbers = sorted(int(s.getPath().getName()[6:-5]) for s in found or [])
    read: list[Entry] = []
    for number in reversed(numbers):
        stream = files.open(_path(spark, f"{processed}/log/entry-{number:012d}.json"))
        try:
            said = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        read.append(Entry(number, said["index"], said["full"], said["run_id"]))
        if said["full"]:
            break
    return read[::-1]


def _indexed(spark: SparkSession, processed: str, known: list[Entry]) -> DataFrame:
    """Every line of the entries' indexes with the number of its entry."""
    if not known:
        return spark.createDataFrame([], f"{_POINTER}, slot int, entry bigint")
    parts = [
        spark.read.schema(f"{_POINTER}, slot int, entry bigint")
        .parquet(f"{processed}/log/{e.index}")
        .withColumn("entry", F.coalesce("entry", F.lit(e.number).cast("bigint")))
        for e in known
    ]
    return reduce(DataFrame.unionByName, parts)


def _latest(lines: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct(*_COLUMNS[1:]), "entry").alias("p")
    return lines.groupBy("partner_batch_id", "slot").agg(newest, F.max("entry").alias("entry"))


def current(spark: SparkSession, processed: str, ids: DataFrame | None = None) -> DataFrame:
    """(partner_batch_id, version, source_key, finished_at) of the batches that have output.

    ``ids`` (partner_batch_id) restricts it to these batches: then only their slots of the
    index are read.
    """
    lines = _indexed(spark, processed.rstrip("/"), entries(spark, processed.rstrip("/")))
    if ids is not None:
        wanted = ids.select("partner_batch_id").where("partner_batch_id IS NOT NULL").distinct()
        slots = [r.slot for r in wanted.select(_slot(F.col("partner_batch_id")).alias("slot")).distinct().collect()]
        lines = lines.where(F.col("slot").isin(slots)).join(wanted, "partner_batch_id", "left_semi")
    return (
        _latest(lines).select("partner_batch_id", "p.*").where(F.col("version").isNotNull())
    )


def _rename_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, target).toUri(), conf)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        context.rename(_path(spark, source), _path(spark, target), options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def _write_index(lines: DataFrame, processed: str, name: str) -> None:
    spread = lines.withColumn("slot", _slot(F.col("partner_batch_id")))
    spread.repartition("slot").write.partitionBy("slot").parquet(f"{processed}/log/{name}")


def commit(
    spark: SparkSession,
    processed: str,
    run_id: str,
    pointers: DataFrame,
    compact_after: int = COMPACT_AFTER,
) -> int:
    """Make ``pointers`` (partner_batch_id, version, source_key, finished_at) count.

    A null version takes the batch's output out. Returns the number of the entry.
    """
    processed = processed.rstrip("/")
    index = f"index-{uuid.uuid4().hex}"
    lines = pointers.select(*_COLUMNS).withColumn("entry", F.lit(None).cast("bigint"))
    _write_index(lines, processed, index)
    number = _append(spark, processed, {"index": index, "full": False, "run_id": run_id})
    if len(entries(spark, processed)) > compact_after:
        compact(spark, processed)
    return number


def _append(spark: SparkSession, processed: str, said: dict, number: int | None = None) -> int:
    """Write an entry under the next free number, or under ``number`` if that is free (else 0)."""
    files = _file_system(spark, processed)
    waiting = f"{processed}/log/.entry-{uuid.uuid4().hex}"
    stream = files.create(_path(spark, waiting), True)
    try:
        stream.write(bytearray(json.dumps(said).encode()))
    finally:
        stream.close()
    wanted = number
    while True:
        if wanted is None:
            known = entries(spark, processed)
            number = known[-1].number + 1 if known else 1
        if _rename_if_absent(spark, waiting, f"{processed}/log/entry-{number:012d}.json"):
            return number
        if wanted is not None:
            files.delete(_path(spark, waiting), False)
            return 0


def compact(spark: SparkSession, processed: str) -> int:
    """One entry that stands for all so far; 0 if another run committed in between."""
    processed = processed.rstrip("/")
    known = entries(spark, processed)
    if not known:
        return 0
    index = f"index-{uuid.uuid4().hex}"
    latest = _latest(_indexed(spark, processed, known))
    _write_index(latest.select("partner_batch_id", "p.*", "entry"), processed, index)
    said = {"index": index, "full": True, "run_id": "compaction"}
    return _append(spark, processed, said, known[-1].number + 1)


def publish(
    spark: SparkSession,
    processed: str,
    run_id: str,
    files: DataFrame,
    valid: DataFrame,
    exceptions: DataFrame,
    shared: DataFrame,
    processed_at: Column,
    spread_out: bool = False,
) -> str:
    """Write a version of every batch of ``files`` and commit them together; returns its name.

    A run that was committed before is not written again. ``files`` has partner_batch_id,
    source_key and the counts of each file.
    """
    processed = processed.rstrip("/")
    if any(e.run_id == run_id for e in entries(spark, processed)):
        return run_id
    version = f"{run_id}-{uuid.uuid4().hex}"
    folder = f"{processed}/data/version={version}"
    write_transactions(valid, files, folder, spread_out, fresh=True)
    write_summaries(files, exceptions, shared, folder, processed_at, fresh=True)
    pointers = files.select(
        "partner_batch_id",
        F.lit(version).alias("version"),
        "source_key",
        processed_at.cast("timestamp").alias("finished_at"),
    )
    commit(spark, processed, run_id, pointers)
    return version


def _read(spark: SparkSession, processed: str, kind: str, load) -> DataFrame | None:
    """An object of the current version of every batch; other versions' folders are not listed."""
    processed = processed.rstrip("/")
    counted = materialise(current(spark, processed), "pointers")
    pointers = counted.df.select(F.col("version").alias("v"), F.col("partner_batch_id").alias("b"))
    versions = [r.v for r in pointers.select("v").distinct().collect()]  # as many as runs
    paths = [f"{processed}/data/version={v}" for v in versions]
    if not paths:
        return None
    rows = load(paths).where(F.col("object") == kind)
    return rows.join(
        pointers, (F.col("version") == F.col("v")) & (F.col("batch") == F.col("b")), "left_semi"
    )


def read_transactions(spark: SparkSession, processed: str, columns: list[str]) -> DataFrame | None:
    """Passing rows of the current versions, with ``batch`` and ``version``; None without any."""
    schema = ", ".join(f"{c} string" for c in [*columns, "version", "batch", "object"])
    reader = spark.read.options(
        header="true", quote='"', escape='"', basePath=f"{processed.rstrip('/')}/data"
    ).schema(schema)
    rows = _read(spark, processed, TRANSACTIONS, reader.csv)
    return None if rows is None else rows.drop("object")


def read_summaries(spark: SparkSession, processed: str) -> DataFrame | None:
    """(value, version, batch): the summary document of every current version; None without any."""
    reader = spark.read.option("basePath", f"{processed.rstrip('/')}/data")
    rows = _read(
        spark, processed, SUMMARY,
        lambda paths: reader.schema("value string, version string, batch string, object string").text(paths, wholetext=True),
    )
    return None if rows is None else rows.drop("object")


def retire(spark: SparkSession, processed: str, run_id: str, batches: DataFrame) -> int:
    """Take the output of ``batches`` (partner_batch_id) out; the data goes with ``sweep``."""
    none = batches.select("partner_batch_id").distinct().select(
        "partner_batch_id",
        F.lit(None).cast("string").alias("version"),
        F.lit(None).cast("string").alias("source_key"),
        F.lit(None).cast("timestamp").alias("finished_at"),
    )
    return commit(spark, processed, run_id, none)


def unused(spark: SparkSession, processed: str) -> DataFrame:
    """(version, batch): folders of versions that count no more, from the listing of the data.

    Versions of runs that never committed are among them, so sweep when no run is at work.
    """
    processed = processed.rstrip("/")
    objects = list_objects(spark, f"{processed}/data").select(
        F.regexp_extract("source_key", "/version=([^/]+)/batch=([^/]+)/", 1).alias("version"),
        F.regexp_extract("source_key", "/version=([^/]+)/batch=([^/]+)/", 2).alias("batch"),
    )
    kept = current(spark, processed).select("version", F.col("partner_batch_id").alias("batch"))
    return objects.where("batch <> ''").distinct().join(kept, ["version", "batch"], "left_anti")


def sweep(spark: SparkSession, processed: str) -> int:
    """Delete the folders of ``unused`` by tasks; returns how many. Repeating it does no harm."""
    uri = qualified_uri(spark, processed.rstrip("/"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(uri)
        for rows in batches:
            gone = 0
            for version, batch in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                try:
                    files.delete_dir(f"{root}/data/version={version}/batch={batch}")
                    gone += 1
                except FileNotFoundError:
                    pass
            yield pa.RecordBatch.from_pydict({"gone": pa.array([gone], pa.int64())})

    found = materialise(unused(spark, processed).select("version", "batch"), "unused")
    spread = spread_files(found.df, found.rows, "version", "batch")
    gone = spread.mapInArrow(remove, "gone long").agg(F.sum("gone")).first()[0] or 0
    release(spark, found.path)
    return gone
