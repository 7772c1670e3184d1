import datetime

from conftest import AS_OF, row

from batchgate.plans import process_incoming
from batchgate.sinks import expired_batches, processed_batches, remove_batches


def test_ninety_full_days(spark):
    day = datetime.date.fromisoformat(AS_OF)
    batches = spark.createDataFrame(
        [
            (str(age), datetime.datetime.combine(day - datetime.timedelta(age), datetime.time(23)))
            for age in (0, 89, 90, 91, 400)
        ],
        "partner_batch_id string, finished_at timestamp",
    )
    assert {r.partner_batch_id for r in expired_batches(batches, AS_OF).collect()} == {"91", "400"}


def test_expired_output_is_removed(spark, bucket):
    for batch in "AB":
        bucket.csv(f"transactions_2024-02-14_{batch}.csv", row())
    run = process_incoming(spark, bucket.path, as_of=AS_OF)
    batches = processed_batches(spark, run.processed)
    assert batches.where("finished_at is not null").count() == 2
    soon = datetime.date.today() + datetime.timedelta(days=80)
    assert expired_batches(batches, soon).count() == 0
    late = datetime.date.today() + datetime.timedelta(days=92)
    expired = expired_batches(batches, late).where("partner_batch_id = 'A'")
    assert remove_batches(spark, run.processed, expired) == 1
    left = processed_batches(spark, run.processed).collect()
    assert [r.partner_batch_id for r in left] == ["B"]
    # Once more, with names that were never there.
    unknown = spark.createDataFrame([("A",), ("Z",), (None,)], "partner_batch_id string")
    assert remove_batches(spark, run.processed, unknown) == 0
    assert [r.partner_batch_id for r in processed_batches(spark, run.processed).collect()] == ["B"]
