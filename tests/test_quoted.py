"""Line breaks in quoted fields, in files of several splits, against Python's csv."""

import csv
import random

import pytest
from conftest import AS_OF, row
from pyspark.sql import functions as F

from batchgate import schema as S
from batchgate.operators import gate as G
from batchgate.plans import process_incoming
from batchgate.sources import csv_files as C
from batchgate.sources.quoted import opens, stays_open

NAME = "incoming/transactions_2024-02-14_{}.csv"


def open_after(line, inside):
    """Python's reader decides: does it ask for another line?"""
    given = (['"' + line] if inside else [line]) + ['"'] * 2
    asked = 0

    def lines():
        nonlocal asked
        for g in given:
            asked += 1
            yield g

    next(csv.reader(lines()), None)
    return asked > 1


def test_lines_as_functions(spark):
    rnd = random.Random(2)
    lines = ["".join(rnd.choice('",a b"') for _ in range(rnd.randrange(0, 14))) for _ in range(3000)]
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    got = frame.select("value", opens(F.col("value")).alias("none"), stays_open(F.col("value")).alias("open"))
    for r in got.collect():
        assert (r.none, r.open) == (open_after(r.value, False), open_after(r.value, True)), r.value


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "8192", "spark.sql.files.openCostInBytes": "1024"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def messy(rnd, n, broken=True):
    """Rows whose fields have breaks, quotes and commas; some rows are short or long."""
    out = []
    for i in range(n):
        fields = [f"T{i}"]
        for _ in range(11):
            text = "".join(rnd.choice('ab,"  \n' if broken else "ab,c") for _ in range(rnd.randrange(0, 9)))
            fields.append(text)
        out.append(fields[: rnd.choice([12, 12, 12, 5])] + (["more"] if rnd.random() < 0.05 else []))
    return out


def written(rows, header=S.TRANSACTION_COLUMNS, end="\r\n"):
    import io

    text = io.StringIO(newline="")
    writer = csv.writer(text, lineterminator=end)
    writer.writerow(header)
    writer.writerows(rows)
    return text.getvalue()


def read_back(text):
    found = []
    for r in csv.DictReader(text.splitlines()):
        found.append(tuple(r[c] for c in S.TRANSACTION_COLUMNS))
    return found


def test_records_equal_the_csv_module(spark, bucket, small_splits):
    rnd = random.Random(7)
    texts = {
        "A": written(messy(rnd, 2500)),
        "PLAIN": written(messy(rnd, 300, broken=False)),
        "ORDER": written([r[::-1] for r in messy(rnd, 900) if len(r) == 12], S.TRANSACTION_COLUMNS[::-1], "\n"),
        # One field goes on for several splits.
        "LONG": written([["T0", "x\n" * 20_000, *["v"] * 10], ["T1", "y", *["w"] * 10]]),
        "HEAD": written([["T0", *["v"] * 12]], ["transaction_id", "odd\nname", *S.TRANSACTION_COLUMNS[1:]]),
    }
    for batch, text in texts.items():
        bucket.put(NAME.format(batch)[9:], text)
    profile = C.profile_files(spark, bucket.path).cache()
    assert {r.source_key for r in profile.where("quoted_breaks").collect()} == {NAME.format(b) for b in texts if b != "PLAIN"}
    assert C._lines(spark, bucket.path, S.MAX_FILE_BYTES, "incoming/", None).select("source_key", "block").distinct().count() > 20
    records = C.read_records(spark, bucket.path, profile)
    layouts = C.find_layouts(spark, profile, records=records)
    rows = C.read_batch_csv(spark, bucket.path, layouts, records=records)
    got = {}
    for r in sorted(rows.collect(), key=lambda r: r.row_seq):
        got.setdefault(r.source_key, []).append(tuple(r[c] for c in S.TRANSACTION_COLUMNS))
    for batch, text in texts.items():
        assert got[NAME.format(batch)] == read_back(text), batch


def test_pipeline_reads_breaks_and_fails_overlong_fields(spark, bucket):
    good = row(merchant_name="two\nlines, one name")
    bucket.put(NAME.format("GOOD")[9:], written([[good[c] for c in S.TRANSACTION_COLUMNS]]))
    bucket.put(NAME.format("OVER")[9:], written([["x" * 100, "line\n" * 40_000, *["v"] * 10]]))
    bucket.put(NAME.format("ENDLESS")[9:], ",".join(S.TRANSACTION_COLUMNS) + '\n"never closed\n' + "a,b\n" * 900_000)
    run = process_incoming(spark, bucket.path, as_of=AS_OF)
    found = {r.source_key[len("incoming/transactions_2024-02-14_") : -4]: r for r in run.files.collect()}
    assert (found["GOOD"].disposition, found["GOOD"].passed) == (G.ACCEPTED, 1)
    assert {(found[b].disposition, found[b].reason) for b in ("OVER", "ENDLESS")} == {(G.FAILED, G.REASON_FIELD)}
    assert "two" + "lines, one name" in bucket.read("GOOD", "transactions.csv")
    assert bucket.read("OVER", "transactions.csv") is None


def test_text_is_written_and_moved_a_bounded_number_of_times(spark, bucket, monkeypatch):
    """Tables that hold a text: the staged lines, the records, and those of several splits."""
    from batchgate.sources import quoted as Q

    kept = []
    keep = Q.materialise

    def noted(df, name, *args, **options):
        if "value" in df.columns:
            kept.append(name)
        return keep(df, name, *args, **options)

    monkeypatch.setattr(Q, "materialise", noted)
    bucket.put(NAME.format("A")[9:], written(messy(random.Random(3), 400)))
    C.read_records(spark, bucket.path, C.profile_files(spark, bucket.path))
    assert kept == ["quoted-lines", "records", "spanning"]
