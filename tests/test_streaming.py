from conftest import AS_OF, row

from batchgate.streaming import stream_incoming, stream_versions


def drain(spark, bucket, tmp_path):
    query = stream_incoming(spark, bucket.path, str(tmp_path / "checkpoint"), 2, as_of=AS_OF)
    query.awaitTermination()
    assert query.exception() is None


def test_files_are_processed_once_as_they_arrive(spark, bucket, tmp_path):
    for batch in "ABC":
        bucket.csv(f"transactions_2024-02-14_{batch}.csv", row(), mtime=1_000_000)
    bucket.csv("junk.csv", row(), mtime=1_000_000)
    drain(spark, bucket, tmp_path)
    for batch in "ABC":
        assert bucket.read(batch, "transactions.csv").count("\r\n") == 2
        assert bucket.read(batch, "summary.json")
    alerts = spark.read.parquet(f"{bucket.path}/alerts")
    assert alerts.count() == 1
    before = bucket.read("A", "summary.json")

    bucket.csv("transactions_2024-02-15_D.csv", row(), mtime=1_000_100)
    bucket.csv("transactions_2024-02-15_B.csv", row(transaction_id="NEW"), mtime=1_000_100)
    drain(spark, bucket, tmp_path)
    assert bucket.read("A", "summary.json") == before
    assert "NEW" in bucket.read("B", "transactions.csv")
    assert bucket.read("D", "summary.json")
    subjects = {r.subject for r in spark.read.parquet(f"{bucket.path}/alerts").collect()}
    assert "Transaction Pipeline: Reprocessing Detected" in subjects


def drain_versions(spark, bucket, tmp_path, max_files=1000):
    query = stream_versions(spark, bucket.path, str(tmp_path / "checkpoint"), max_files, as_of=AS_OF)
    query.awaitTermination()
    assert query.exception() is None


def runs(spark, bucket):
    """How often each file was processed, by its rejections and alerts."""
    found = spark.read.parquet(f"{bucket.path}/alerts").groupBy("run_id").count().collect()
    return {r.run_id: r["count"] for r in found}


def test_file_replaced_in_place_is_processed_again_once(spark, bucket, tmp_path):
    name = "transactions_2024-02-14_A.csv"
    bucket.csv(name, row(), mtime=1_000_000)
    bucket.csv("transactions_2024-02-14_B.csv", row(), mtime=1_000_000)
    bucket.csv("junk.csv", row(), mtime=1_000_000)
    drain_versions(spark, bucket, tmp_path)
    other = bucket.read("B", "summary.json")
    assert other and bucket.read("A", "transactions.csv").count("\r\n") == 2
    first = runs(spark, bucket)
    assert list(first.values()) == [1]

    # The same size, another time.
    bucket.csv(name, row(merchant_name="Harbour Paints"), mtime=1_000_100)
    drain_versions(spark, bucket, tmp_path, max_files=0)
    assert "Harbour Paints" in bucket.read("A", "transactions.csv")
    assert bucket.read("B", "summary.json") == other
    second = runs(spark, bucket)
    assert len(second) == 2  # the new version, as reprocessing; junk and B not again

    drain_versions(spark, bucket, tmp_path)
    assert runs(spark, bucket) == second
