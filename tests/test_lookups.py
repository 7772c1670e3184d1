"""Lookups give the same answer by broadcast and by shuffle, hot keys or not."""

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from batchgate.fixtures import landed_transactions
from batchgate.operators import batch as B
from batchgate.operators.lookups import lookup
from batchgate.session import materialise

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, a third have none."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 3 == 1, F.concat(F.lit("k"), (n % 50).cast("string")))
    rows = spark.range(6000).select(n.alias("row_seq"), key.alias("k"))
    values = rows.where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return rows, materialise(values.where("k != 'k7'"), "values", F.octet_length("k"))


def answer(rows, table, **limits):
    out = lookup(rows, table, {"k": F.col("k")}, ["n"], "n", F.col("row_seq"), **limits)
    assert out.columns == [*rows.columns, "n"]
    return out


def test_shuffled_equals_broadcast(skewed):
    rows, table = skewed
    by_broadcast = answer(rows, table)
    by_shuffle = answer(rows, table, max_rows=0, hot_keys=2)
    assert "SortMergeJoin" in by_shuffle._jdf.queryExecution().toString()
    assert "SortMergeJoin" not in by_broadcast._jdf.queryExecution().toString()
    assert by_shuffle.exceptAll(by_broadcast).count() == 0
    assert by_shuffle.count() == 6000


def test_hot_and_missing_keys_spread_over_the_shuffle(skewed, spark):
    rows, table = skewed
    out = answer(rows, table, max_rows=0, hot_keys=1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [
            r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)


def test_empty_table_needs_no_join(skewed):
    rows, table = skewed
    empty = materialise(table.df.where("false"), "empty")
    out = answer(rows, empty)
    assert "Join" not in out._jdf.queryExecution().toString()
    assert out.where("n is not null").count() == 0


def test_validation_is_the_same_by_shuffle(spark):
    rows = landed_transactions(spark, SF)
    usual = B.validate_batch(rows, AS_OF)
    shuffled = B.validate_batch(rows, AS_OF, max_rows=0, hot_keys=2)
    for result in (
        lambda b: b.exceptions_long(),
        lambda b: b.valid_rows(),
        lambda b: b.summary(),
    ):
        a, b = result(usual), result(shuffled)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_one_id_on_a_third_of_the_rows(spark):
    """Counts stay exact, and nothing is gathered per row of the hot id."""
    rows = landed_transactions(spark, SF)
    hot = rows.withColumns(
        {
            "transaction_id": F.when(F.col("row_seq") % 3 == 0, "HOT").otherwise(
                F.col("transaction_id")
            ),
            "source_key": F.lit("one"),
        }
    )
    result = B.validate_batch(hot, AS_OF)
    n = result.rows.where(F.col("ok") & (F.col("transaction_id") == "HOT")).count()
    assert n > 256
    repeated = result.rows.where((F.col("transaction_id") == "HOT") & F.col("ok"))
    assert {r.same_id for r in repeated.select("same_id").distinct().collect()} == {n}
    marked = result.exceptions().where("shared")
    assert marked.where("transaction_id = 'HOT'").count() == n
    # Three further pairs of rows share an id.
    others = marked.where("transaction_id <> 'HOT'").select("transaction_id").collect()
    assert len(others) == 6 and len(set(others)) == 3
    longest = marked.agg(F.max(F.size("violations"))).first()[0]
    assert longest <= 7
