"""Generated samples: shapes, exact counts, independence of partitioning."""

import math

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from batchgate import schema as S
from batchgate.functions import draw, draw_below
from batchgate.operators import batch as B
from batchgate.operators.linkage import dense_index, link_refunds
from batchgate.plans import bench_workload
from batchgate.sinks import write_csv, write_manifest
from batchgate.sources import read_manifest
from batchgate.synth import clean_rows, generate_benchmark, generate_seeded, row_numbers
from batchgate.synth.defects import DEFECTS, exact_sample

N = 4000


@pytest.fixture(scope="module")
def clean(spark):
    return generate_benchmark(spark, N, 7, "B1", "2024-02-14").persist()


def test_clean_rows_pass(clean):
    result = B.validate_batch(clean, AS_OF)
    [counts] = result.summary().collect()
    assert counts.total_rows == counts.passed == N
    rules = {r.rule for r in result.exceptions_long().select("rule").distinct().collect()}
    assert rules == {"zero_value_transaction"}


def test_distributions(clean):
    def shares(column):
        return {r[0]: r[1] / N for r in clean.groupBy(column).count().collect()}

    for column, weights in (
        ("transaction_type", S.TRANSACTION_TYPES),
        ("status", S.STATUSES),
        ("currency", S.CURRENCIES),
    ):
        got = shares(column)
        assert set(got) == set(weights)
        for value, weight in weights.items():
            assert abs(got[value] - weight) < 4 * math.sqrt(weight * (1 - weight) / N)
    assert set(shares("merchant_name")) == set(S.MERCHANTS)
    assert set(shares("source_system")) == set(S.SOURCE_SYSTEMS)


def test_amounts(clean):
    rows = clean.select("transaction_type", "status", F.col("amount").cast("double").alias("a"))
    live = rows.where("status != 'failed'")
    assert rows.where("status = 'failed' and a != 0").count() == 0
    assert live.where("transaction_type = 'refund' and a >= 0").count() == 0
    assert live.where("transaction_type in ('purchase', 'fee') and a <= 0").count() == 0
    either = live.where("transaction_type in ('transfer', 'adjustment')")
    assert 0.4 < either.where("a > 0").count() / either.count() < 0.6
    stats = live.agg(F.avg(F.ln(F.abs("a"))), F.stddev(F.ln(F.abs("a")))).first()
    assert abs(stats[0] - 3.2) < 0.06 and abs(stats[1] - 0.9) < 0.05


def test_dates(clean):
    days = clean.select(
        F.datediff(F.lit("2024-02-14"), "transaction_date").alias("back"),
        F.datediff("posted_date", "transaction_date").alias("lag"),
    )
    assert {r.back for r in days.distinct().collect()} == {0, 1}
    lags = {r[0]: r[1] / N for r in days.groupBy("lag").count().collect()}
    assert all(abs(lags[k] - w) < 0.05 for k, w in {0: 0.6, 1: 0.3, 2: 0.1}.items())


def test_partitioning_does_not_matter(spark):
    numbers = row_numbers(spark, 500)
    one = clean_rows(numbers.coalesce(1), "B", "2024-02-14", 3)
    many = clean_rows(numbers.repartition(7), "B", "2024-02-14", 3)
    assert one.exceptAll(many).count() == 0
    other = clean_rows(numbers, "B", "2024-02-14", 4)
    assert one.exceptAll(other).count() > 400


def test_dense_index_across_blocks(spark):
    # Positions far apart land in different blocks; numbering has no gaps.
    rows = spark.range(0, 2000).select(
        (F.col("id") % 3).alias("g"), (F.col("id") * 977).alias("pos")
    )
    for g in range(3):
        got = dense_index(rows, ["g"], "pos", "i").where(F.col("g") == g).orderBy("pos").collect()
        assert [r.i for r in got] == list(range(1, len(got) + 1))


def test_links(spark, clean):
    refunds = clean.where("transaction_type = 'refund'")
    targets = clean.where("transaction_type != 'refund'").select(
        F.col("transaction_id").alias("related_transaction_id")
    )
    assert refunds.join(targets, "related_transaction_id", "left_anti").count() == 0
    assert clean.where("transaction_type != 'refund' and related_transaction_id != ''").count() == 0
    only = refunds.withColumn("related_transaction_id", F.lit(""))
    assert link_refunds(only, 1).where("related_transaction_id != ''").count() == 0
    kept = refunds.withColumn("related_transaction_id", F.lit("KEEP"))
    assert link_refunds(kept, 1).where("related_transaction_id != 'KEEP'").count() == 0


@pytest.mark.parametrize("k", [1, 137, 999])
def test_exact_sample(spark, k):
    rows = spark.range(1000).select("id", (F.pmod(F.xxhash64("id"), F.lit(1 << 20))).alias("s"))
    chosen = rows.where(exact_sample(rows, k, F.col("s"), "id"))
    best = sorted((r.s, r.id) for r in rows.collect())[:k]
    assert sorted((r.s, r.id) for r in chosen.collect()) == best
    tied = spark.range(1000).select("id", F.lit(5).alias("s"))
    assert tied.where(exact_sample(tied, k, F.col("s"), "id")).count() == k


@pytest.fixture(scope="module")
def seeded(spark):
    rows, manifest = generate_seeded(spark, N, 0.05, 11, "B1", "2024-02-14")
    return rows.persist(), manifest.persist()


def test_seeded_counts(seeded):
    rows, manifest = seeded
    assert manifest.count() == N * 0.05
    assert manifest.select("transaction_id").distinct().count() == manifest.count()
    names = {d.name: d.severity for d in DEFECTS}
    got = {(r.defect, r.severity) for r in manifest.select("defect", "severity").collect()}
    assert got == set(names.items())
    copies = manifest.where("defect = 'duplicate_transaction'").count()
    assert rows.count() == N + copies
    assert generate_empty_is_one(rows)


def generate_empty_is_one(rows):
    return rows.where("is_copy").select("transaction_id").distinct().count() == rows.where(
        "is_copy"
    ).count()


def test_seeded_defects_show(seeded):
    """Defects that are violations in themselves are all reported."""
    rows, manifest = seeded
    numbered = rows.withColumn("row_seq", F.col("row_seq") * 2 + F.col("is_copy").cast("int"))
    long = B.validate_batch(numbered, AS_OF).exceptions_long()
    found = {(r.transaction_id, r.rule) for r in long.collect()}
    always = {
        "missing_required_field",
        "duplicate_transaction",
        "invalid_enum_value",
        "orphaned_refund",
        "zero_value_transaction",
    }
    for entry in manifest.collect():
        if entry.defect in always:
            assert (entry.transaction_id, entry.defect) in found


def test_at_least_one_defect(spark):
    _, manifest = generate_seeded(spark, 10, 0.0, 1, "B", "2024-02-14")
    assert manifest.count() == 1


def test_manifest_files(spark, seeded, tmp_path):
    _, manifest = seeded
    path = str(tmp_path / "manifest")
    write_manifest(manifest, path)
    back = read_manifest(spark, path)
    assert back.exceptAll(manifest).count() == 0 and back.count() == manifest.count()
    document = '{"T2": {"defect": "a", "severity": "critical"},\n "T1": {"defect": "b", "severity": "warning"}}'
    (tmp_path / "one.json").write_text(document)
    one = read_manifest(spark, str(tmp_path / "one.json"), one_document=True)
    assert sorted(tuple(r) for r in one.collect()) == [
        ("T1", "b", "warning"),
        ("T2", "a", "critical"),
    ]


def test_workload_over_csv(spark, clean, tmp_path):
    path = str(tmp_path / "csv")
    write_csv(clean, path)
    got = bench_workload(spark, path, AS_OF)
    assert got["total_rows"] == got["passed"] == N and got["rejected_critical"] == 0
    assert got["flagged_warning_only"] == clean.where("amount = '0.00'").count()
    assert got["by_transaction_type"] == {
        r[0]: r[1] for r in clean.groupBy("transaction_type").count().collect()
    }


def test_workload_agrees_with_validation_where_both_apply(spark, seeded, tmp_path):
    """Without unsound rows among repeated ids the two ways of counting agree."""
    rows, _ = seeded
    numbered = rows.withColumn("row_seq", F.col("row_seq") * 2 + F.col("is_copy").cast("int"))
    [counts] = B.validate_batch(numbered, AS_OF).summary().collect()
    path = str(tmp_path / "csv")
    write_csv(rows, path)
    got = bench_workload(spark, path, AS_OF)
    assert {k: got[k] for k in B.COUNTS} == {k: counts[k] for k in B.COUNTS}


def test_draws_below_are_even(spark):
    n = 20_000
    drawn = spark.range(n).select(draw_below(F.lit(10), 5, 90, F.col("id")).alias("d"))
    counts = {r.d: r["count"] for r in drawn.groupBy("d").count().collect()}
    assert sorted(counts) == list(range(10))
    # 99.9 % point of chi-square with 9 degrees of freedom
    assert sum((c - n / 10) ** 2 / (n / 10) for c in counts.values()) < 27.9


@pytest.mark.parametrize("n", [1, 3, 2**31, 2**32 + 1, 2**45 + 7, 2**62 - 1])
def test_draws_below_equal_exact_products(spark, n):
    key = F.col("id")
    rows = spark.range(200).select(
        draw_below(F.lit(n), 5, 90, key).alias("d"), *[draw(5, 90, key, k).alias(f"u{k}") for k in (0, 1)]
    )
    for r in rows.collect():
        assert r.d == (((r.u0 >> 1 << 31) + (r.u1 >> 1)) * n) >> 62
    if n > 2**40:
        assert max(r.d for r in rows.collect()) > 2**32
