"""Files processed as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from batchgate import schema as S
from batchgate.plans.pipeline import process_incoming
from batchgate.session import materialise, release
from batchgate.sources.incoming import list_incoming, relative_key

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_incoming(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    max_files: int = 1000,
    available_now: bool = True,
    **options,
) -> StreamingQuery:
    """Run the pipeline on every file that arrives under ``root``/incoming/.

    The stream is one of file names: contents are read by the pipeline itself,
    for the at most ``max_files`` files of a micro-batch. A file is taken once;
    one overwritten in place is not seen again (see ``stream_versions``). A repeated micro-batch replaces its own output.
    """
    root = root.rstrip("/")
    arriving = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(max_files))
        .load(f"{root}/{S.INCOMING_PREFIX}")
        .select(
            F.lit(root).alias("bucket"),
            relative_key(spark, root).alias("source_key"),
            F.col("length").alias("size_bytes"),
            F.col("modificationTime").alias("modified_at"),
        )
    )

    def run(files: DataFrame, batch_id: int) -> None:
        listed = files.withColumn("arrival_seq", F.struct("modified_at", "source_key")).persist()
        keys = [r.source_key for r in listed.select("source_key").collect()]
        process_incoming(
            files.sparkSession,
            root,
            files=listed,
            keys=keys,
            run_id=f"stream-{batch_id:010d}",
            **options,
        )
        listed.unpersist()

    query = arriving.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (query.trigger(availableNow=True) if available_now else query).start()


_LISTING = "bucket string, source_key string, size_bytes bigint, modified_at timestamp"


def _listing(spark: SparkSession, root: str, folder: str, batch_id: int) -> DataFrame:
    """What micro-batch ``batch_id`` found in incoming/: listed once, however often it is run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch={batch_id}")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
        list_incoming(spark, root).write.mode("overwrite").parquet(str(path))
    return spark.read.schema(_LISTING).parquet(str(path))


def stream_versions(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    max_files: int = 1000,
    available_now: bool = True,
    interval: str = "1 minute",
    **options,
) -> StreamingQuery:
    """Run the pipeline on every version of a file that turns up under ``root``/incoming/.

    A version is a key with a modification time and a size: a file overwritten in place is
    processed again, once. Each micro-batch lists the folder by tasks and takes what the
    listing of the batch before did not have, so the state is two listings, whatever went
    through. The listing is written before it is used: a repeated micro-batch takes the
    same versions and replaces its own output. A file that changes twice between two
    listings is taken as it is last; one that goes and comes back unchanged is taken again.

    Up to ``max_files`` new versions are named to the scan, more are read in a scan
    of all of incoming/, of which only they are published.
    """
    root, folder = root.rstrip("/"), f"{checkpoint.rstrip('/')}/listings"
    # The source only counts; what there is to do is found by the listing.
    clock = (
        spark.readStream.format("rate-micro-batch")
        .options(rowsPerBatch=1, numPartitions=1, startTimestamp=0)
        .load()
    )

    def run(_: DataFrame, batch_id: int) -> None:
        now = _listing(spark, root, folder, batch_id)
        taken = now.limit(0) if batch_id == 0 else _listing(spark, root, folder, batch_id - 1)
        fresh = materialise(
            now.join(taken, ["source_key", "modified_at", "size_bytes"], "left_anti").withColumn(
                "arrival_seq", F.struct("modified_at", "source_key")
            ),
            "fresh",
        )
        if fresh.rows:
            keys = None
            if fresh.rows <= max_files:
                keys = [r.source_key for r in fresh.df.select("source_key").collect()]
            run_id = f"versions-{batch_id:010d}"
            process_incoming(spark, root, files=fresh.df, keys=keys, run_id=run_id, **options)
        release(spark, fresh.path, f"{folder}/batch={batch_id - 2}")

    query = clock.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return query.trigger(**trigger).start()
