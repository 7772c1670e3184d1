"""Work on many small files goes by their number, not by their bytes."""

from conftest import AS_OF, row
from pyspark.sql import functions as F

from batchgate import plans
from batchgate.plans import process_incoming
from batchgate.sinks import batches as K
from batchgate.sinks import processed_batches
from checks import queries

NAME = "transactions_2024-02-14_{}.csv"


def some_files(spark, n):
    key = F.concat(F.lit("incoming/transactions_2024-02-14_B"), F.col("id").cast("string"), F.lit(".csv"))
    counts = {c: F.lit(0).cast("bigint") for c in ("total_rows", "passed", "rejected_critical", "flagged_warning_only")}
    return spark.range(n).select(key.alias("source_key"), *[v.alias(c) for c, v in counts.items()])


NO_EXCEPTIONS = (
    "source_key string, row_seq bigint, ok boolean, transaction_id string, "
    "violations array<struct<rule:string,severity:string,detail:string>>, shared boolean"
)
NO_SHARED = "source_key string, transaction_id string, row_seq bigint, rule string, severity string, detail string"


def test_summaries_of_many_batches_are_several_tasks_work(spark):
    none, shared = spark.createDataFrame([], NO_EXCEPTIONS), spark.createDataFrame([], NO_SHARED)
    lines = K.summary_lines(some_files(spark, 250), none, shared, F.lit("now"))
    tasks = lines.select("batch", F.spark_partition_id().alias("task")).distinct().collect()
    assert len({r.batch for r in tasks}) == len(tasks) == 250
    assert len({r.task for r in tasks}) >= 3


def test_many_files_arrive_by_several_tasks(spark):
    keyed = spark.range(1000).select((F.col("id") % 250).cast("string").alias("key"), "id")
    tasks = queries._by_key(keyed).select("key", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(tasks) == 250 and len({r.task for r in tasks}) >= 3


def test_folders_are_there_before_a_commit_replaces(spark, tmp_path):
    K._make_folders(some_files(spark, 120), str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(f"batch=B{i}" for i in range(120))
    # They hold no object, so they are no output; nor is what a commit left behind.
    left = tmp_path / ".spark-staging-1" / "batch=Z" / "object=summary.json"
    left.mkdir(parents=True)
    (left / "part-0").write_text("{}")
    assert processed_batches(spark, str(tmp_path)).count() == 0


def test_only_batches_with_output_have_a_summary_to_clear(spark, bucket, monkeypatch):
    cleared = []
    clear = plans.pipeline.clear_summaries

    def noted(files, processed):
        cleared.append(sorted(r.partner_batch_id for r in files.select("partner_batch_id").collect()))
        clear(files, processed)

    monkeypatch.setattr(plans.pipeline, "clear_summaries", noted)
    bucket.csv(NAME.format("A"), row())
    process_incoming(spark, bucket.path, as_of=AS_OF)
    bucket.csv(NAME.format("C"), row())
    process_incoming(spark, bucket.path, as_of=AS_OF)
    assert cleared == [[], ["A"]]
    assert sorted(r.partner_batch_id for r in processed_batches(spark, f"{bucket.path}/processed").collect()) == ["A", "C"]
