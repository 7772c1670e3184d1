"""Files in a bucket folder, end to end."""

import csv
import io
import json
import os

import pytest
from conftest import AS_OF, BASE, row

from batchgate import schema as S
from batchgate.plans import process_incoming
from batchgate.sinks import batches as K
from batchgate.sources import csv_files as C
from batchgate.sources import list_incoming

HEADER = ",".join(S.TRANSACTION_COLUMNS) + "\r\n"
csv.field_size_limit(1 << 20)


def rows_of(bucket, batch):
    text = bucket.read(batch, "transactions.csv")
    return None if text is None else list(csv.DictReader(io.StringIO(text, newline="")))


def summary_of(bucket, batch):
    text = bucket.read(batch, "summary.json")
    return None if text is None else json.loads(text)


def name(batch, day="2024-02-14"):
    return f"transactions_{day}_{batch}.csv"


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """One run over one file per case."""
    root = tmp_path_factory.mktemp("odd dir+a%20b")
    (root / "incoming" / "sub").mkdir(parents=True)

    def put(file, content):
        data = content if isinstance(content, bytes) else content.encode()
        (root / "incoming" / file).write_bytes(data)

    def table(file, *rows, columns=S.TRANSACTION_COLUMNS):
        out = io.StringIO()
        writer = csv.DictWriter(out, columns, restval="extra", extrasaction="ignore")
        writer.writeheader()
        writer.writerows(rows)
        put(file, out.getvalue())

    table("not_a_valid_filename.csv", row())
    table("transactions_2024-02-14_under_score.csv", row())
    put("notes.txt", "not a csv")
    table(name("GOOD"), row(), row(transaction_id="T2", amount=""))
    table(name("EMPTYISH"), row(amount=""))
    put(name("HEADER"), ",".join(S.TRANSACTION_COLUMNS) + "\n")
    put(name("BYTES"), b"\xff\xfe\x00transaction_id\n1,2\n")
    latin = ",".join(S.TRANSACTION_COLUMNS) + "\n" + ",".join(row(merchant_name="Caf@").values())
    put(name("LATIN"), latin.replace("@", "\xe9").encode("latin-1"))
    table(name("UTF"), row(merchant_name="Café Ünïcode, \"quoted\" 中"))
    table(name("SAME1"), row(transaction_id="TXN-1"))
    table(name("SAME2"), row(transaction_id="TXN-1"))
    table(name("ORDER"), row(), columns=[*reversed(S.TRANSACTION_COLUMNS), "extra"])
    table(name("NOSTATUS"), row(), columns=[c for c in S.TRANSACTION_COLUMNS if c != "status"])
    table(
        name("NOSTATUSBAD"),
        row(amount=""),
        columns=[c for c in S.TRANSACTION_COLUMNS if c != "status"],
    )
    table(
        name("NOCURRENCY"),
        row(status="odd"),
        columns=[c for c in S.TRANSACTION_COLUMNS if c != "currency"],
    )
    table(name("NOTYPE"), row(), columns=[c for c in S.TRANSACTION_COLUMNS if c != "transaction_type"])
    table(name("NOPOSTED"), row(), columns=[c for c in S.TRANSACTION_COLUMNS if c != "posted_date"])
    table(name("BADDAY", "2024-13-45"), row())
    table(name("FRESH", "2024-02-12"), row())
    table(name("STALE", "2024-02-11"), row())
    table("sub/" + name("AHEAD", "2024-02-19"), row())
    ragged = "T1,b,a,2024-02-14,2024-02-14,purchase,5\nT2,b\n\n"
    long = ",".join(row(transaction_id="T3").values()) + ",more,and more\n"
    put(name("RAGGED"), ",".join(S.TRANSACTION_COLUMNS) + "\n" + ragged + long)
    table(name("BIGFIELD"), row(merchant_name="x" * 131_073))
    # A line with a field too many, whose quoted text has commas and quotes.
    wide = row(merchant_name='"' + 'y"",' * 50_000 + '"')
    put(
        name("LONGRAGGED"),
        ",".join(S.TRANSACTION_COLUMNS) + "\n" + ",".join([*wide.values(), "more"]) + "\nT2,b\n",
    )
    spaced = row(merchant_name='  two "spaces" ', source_system=" ")
    table(name("SPACES"), spaced)
    columns = ["amount", *S.TRANSACTION_COLUMNS]
    put(
        name("TWICE"),
        ",".join(columns) + "\n" + ",".join(["oops", *row().values()]) + "\n",
    )
    result = process_incoming(spark, str(root), as_of=AS_OF)
    files = {r.source_key: r for r in result.files.collect()}

    class Run:
        path = str(root)

        def file(self, batch):
            return next(f for f in files.values() if f.partner_batch_id == batch)

        def read(self, batch, kind):
            folder = root / "processed" / f"batch={batch}" / f"object={kind}"
            parts = sorted(folder.glob("part-*")) if folder.exists() else []
            return "".join(p.read_text(newline="") for p in parts) if parts else None

    out = Run()
    out.files, out.result = files, result
    out.alerts = [tuple(r) for r in result.alerts().select("source_key", "subject", "message").collect()]
    out.dead = {r.source_key: r.error for r in result.dead_letters().collect()}
    return out


def test_only_csv_files_are_listed(run):
    assert "incoming/notes.txt" not in run.files
    assert f"incoming/sub/{name('AHEAD', '2024-02-19')}" in run.files


@pytest.mark.parametrize("file", ["not_a_valid_filename.csv", "transactions_2024-02-14_under_score.csv"])
def test_unconventional_names_are_rejected(run, file):
    key = f"incoming/{file}"
    assert run.files[key].disposition == "rejected_filename"
    [(_, subject, message)] = [a for a in run.alerts if a[0] == key]
    assert subject == "Transaction Pipeline: Rejected File"
    assert message == (
        "A file was rejected: filename does not match the expected convention\n\n"
        f"Bucket: {run.path}\nKey: {key}\n\n"
        "The file has been left in place. Review it manually in the AWS Console and "
        "rename, move, or delete it as appropriate."
    )
    assert os.path.exists(f"{run.path}/{key}")


def test_good_and_bad_rows_part(run):
    assert [r["transaction_id"] for r in rows_of(run, "GOOD")] == [BASE["transaction_id"]]
    assert rows_of(run, "GOOD")[0]["amount"] == BASE["amount"]
    doc = summary_of(run, "GOOD")
    assert doc["counts"] == {
        "total_rows": 2,
        "passed": 1,
        "rejected_critical": 1,
        "flagged_warning_only": 0,
    }
    assert doc["partner_batch_id"] == "GOOD"
    assert doc["source_key"] == f"incoming/{name('GOOD')}"
    assert doc["exceptions"] == [
        {
            "transaction_id": "T2",
            "violations": [
                {
                    "rule": "missing_required_field",
                    "severity": "critical",
                    "detail": "Required field 'amount' is blank.",
                }
            ],
        }
    ]
    assert not [a for a in run.alerts if "GOOD" in a[0]]


@pytest.mark.parametrize("batch, total", [("EMPTYISH", 1), ("HEADER", 0)])
def test_header_is_written_without_rows(run, batch, total):
    assert run.read(batch, "transactions.csv") == HEADER
    assert summary_of(run, batch)["counts"]["total_rows"] == total


@pytest.mark.parametrize("batch", ["BYTES", "LATIN"])
def test_undecodable_files_are_rejected_whole(run, batch):
    assert run.file(batch).disposition == "rejected_encoding"
    [(_, _, message)] = [a for a in run.alerts if batch in a[0]]
    assert "file could not be decoded as UTF-8" in message
    assert run.read(batch, "summary.json") is None
    assert not [k for k in run.dead if batch in k]


def test_text_comes_out_as_it_went_in(run):
    assert rows_of(run, "UTF")[0]["merchant_name"] == 'Café Ünïcode, "quoted" 中'
    [spaced] = rows_of(run, "SPACES")
    assert spaced["merchant_name"] == '  two "spaces" ' and spaced["source_system"] == " "


def test_same_id_in_two_files_is_no_duplicate(run):
    for batch in ("SAME1", "SAME2"):
        assert summary_of(run, batch)["counts"]["passed"] == 1


def test_columns_are_matched_by_header(run):
    assert rows_of(run, "ORDER") == [row()]
    assert run.read("ORDER", "transactions.csv").startswith(HEADER)
    assert rows_of(run, "TWICE") == [row()]


def test_missing_columns(run):
    errors = {k.split("_")[-1][:-4]: v for k, v in run.dead.items()}
    assert errors["NOSTATUS"] == "no column 'status'"
    assert errors["NOTYPE"] == "no column 'transaction_type'"
    assert run.read("NOSTATUS", "summary.json") is None
    # Nothing sound in the file, so nothing ever asks for its status.
    assert summary_of(run, "NOSTATUSBAD")["counts"]["rejected_critical"] == 1
    # The status is unknown already, so the currency is not looked at.
    assert summary_of(run, "NOCURRENCY")["counts"]["flagged_warning_only"] == 1
    assert rows_of(run, "NOCURRENCY")[0]["currency"] == ""
    [entry] = summary_of(run, "NOPOSTED")["exceptions"]
    assert [v["rule"] for v in entry["violations"]] == ["date_logic_violation"]


def test_dead_letters(run):
    key = f"incoming/{name('BADDAY', '2024-13-45')}"
    assert run.dead[key] == "file date '2024-13-45' is not a date"
    assert not [a for a in run.alerts if a[0] == key]


def test_long_fields_are_fields_like_others(run):
    assert rows_of(run, "BIGFIELD")[0]["merchant_name"] == "x" * 131_073
    [entry] = summary_of(run, "LONGRAGGED")["exceptions"]
    assert entry["transaction_id"] == "T2"
    [kept] = rows_of(run, "LONGRAGGED")
    assert kept["merchant_name"] == 'y",' * 50_000


def test_staleness_only_warns(run):
    assert run.file("FRESH").staleness is None
    assert run.file("STALE").staleness == "Filename date 2024-02-11 is 4 days in the past"
    assert run.file("AHEAD").staleness == "Filename date 2024-02-19 is 4 days in the future"
    assert len(rows_of(run, "STALE")) == len(rows_of(run, "AHEAD")) == 1


def test_short_and_long_rows(run):
    doc = summary_of(run, "RAGGED")
    assert doc["counts"] == {
        "total_rows": 3,
        "passed": 2,
        "rejected_critical": 1,
        "flagged_warning_only": 1,
    }
    by_id = {e["transaction_id"]: [v["detail"] for v in e["violations"]] for e in doc["exceptions"]}
    assert by_id["T1"] == ["status 'None' not recognized."]
    assert by_id["T2"] == [
        f"Required field '{f}' is blank." for f in ("account_id", "amount", "transaction_date")
    ]
    assert [r["transaction_id"] for r in rows_of(run, "RAGGED")] == ["T1", "T3"]
    assert rows_of(run, "RAGGED")[0]["status"] == ""


def test_logs_are_written(run, spark):
    alerts = spark.read.parquet(f"{run.path}/alerts").where(f"run_id = '{run.result.run_id}'")
    assert alerts.count() == len(run.alerts) == 4
    assert spark.read.parquet(f"{run.path}/dead_letters").count() == len(run.dead) == 3


def test_reprocessing_replaces_only_its_batch(spark, bucket):
    bucket.csv(name("A"), row(), row(transaction_id="T2"))
    bucket.csv(name("B"), row())
    first = process_incoming(spark, bucket.path, as_of=AS_OF)
    assert first.alerts().count() == 0
    before = bucket.read("B", "summary.json")

    bucket.csv(name("A"), row(amount=""))
    again = process_incoming(spark, bucket.path, as_of=AS_OF, keys=[f"incoming/{name('A')}"])
    [alert] = again.alerts().collect()
    assert alert.subject == "Transaction Pipeline: Reprocessing Detected"
    assert alert.message == (
        "A file was received for a batch that has already been processed. "
        f"The previous result will be overwritten.\n\nBucket: {bucket.path}\n"
        f"Key: incoming/{name('A')}\nPartner batch ID: A\n\n"
        "No action is required unless this reprocessing was unexpected."
    )
    # No passing row is left, and none of the former ones survives.
    assert bucket.read("A", "transactions.csv") == HEADER
    assert summary_of(bucket, "A")["counts"]["total_rows"] == 1
    assert bucket.read("B", "summary.json") == before


def test_last_file_of_a_batch_wins(spark, bucket):
    bucket.csv(name("A", "2024-02-13"), row(), row(transaction_id="T2"), mtime=1000)
    bucket.csv(name("A", "2024-02-15"), row(), mtime=2000)
    bucket.csv(name("A", "2024-02-14"), row(transaction_id="LAST"), mtime=3000)
    bucket.put(name("A", "2024-02-16"), b"\xff\xfe", mtime=4000)
    bucket.put(name("C"), b"\xff\xfe", mtime=4000)
    bucket.csv(name("C", "2024-02-15"), row(), mtime=5000)
    result = process_incoming(spark, bucket.path, as_of=AS_OF)
    files = {r.file_date: r for r in result.files.where("partner_batch_id = 'A'").collect()}
    flags = {d: (f.reprocessing, f.superseded) for d, f in files.items()}
    assert flags == {
        "2024-02-13": (False, True),
        "2024-02-15": (True, True),
        "2024-02-14": (True, False),
        "2024-02-16": (True, False),
    }
    assert [r["transaction_id"] for r in rows_of(bucket, "A")] == ["LAST"]
    assert summary_of(bucket, "A")["source_key"] == f"incoming/{name('A')}"
    # A rejected file leaves no output, so the next one is not reprocessing.
    assert not result.files.where("partner_batch_id = 'C' and reprocessing").count()


def test_size_limit_is_inclusive(spark, bucket):
    bucket.csv(name("EXACT"), row())
    size = os.path.getsize(f"{bucket.path}/incoming/{name('EXACT')}")
    bucket.csv(name("OVER"), row(merchant_name=BASE["merchant_name"] + "s"))
    result = process_incoming(spark, bucket.path, as_of=AS_OF, max_bytes=size)
    assert len(rows_of(bucket, "EXACT")) == 1
    assert bucket.read("OVER", "summary.json") is None
    [alert] = result.alerts().collect()
    assert f"file size ({size + 1} bytes) exceeds the {size}-byte limit" in alert.message


def test_files_that_fail_the_gate_are_not_opened(spark, bucket):
    bucket.csv(name("A"), row())
    bucket.csv("other.csv", row())
    bucket.csv(name("B"), *[row(transaction_id=f"T{i}") for i in range(50)])
    profile = C.profile_files(spark, bucket.path, max_bytes=1000)
    assert [r.source_key for r in profile.collect()] == [f"incoming/{name('A')}"]
    rows = C.read_batch_csv(spark, bucket.path, max_bytes=1000)
    assert [r.source_key for r in rows.collect()] == [f"incoming/{name('A')}"]
    assert rows.rdd.getNumPartitions() == 1


def test_rows_of_a_split_file_stay_in_order(spark, bucket):
    ids = [f"T{i:05d}" for i in range(3000)]
    bucket.csv(name("A"), *[row(transaction_id=i) for i in ids])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        rows = C.read_batch_csv(spark, bucket.path)
        assert rows.rdd.getNumPartitions() > 5
        assert [r.transaction_id for r in rows.orderBy("row_seq").collect()] == ids
        assert rows.select("row_seq").distinct().count() == 3000
        process_incoming(spark, bucket.path, as_of=AS_OF)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # Each part has a header of its own.
    written = [r["transaction_id"] for r in rows_of(bucket, "A")]
    assert sorted(i for i in written if i != "transaction_id") == ids


def test_shuffled_run_writes_rows_in_order(spark, bucket):
    rows = [row(transaction_id=f"T{i:05d}") for i in range(400)]
    twins = [row(transaction_id="DUP"), row(transaction_id="DUP")]
    bucket.csv(name("A"), *rows[:200], *twins, *rows[200:])
    bucket.csv(name("B"), row())
    process_incoming(spark, bucket.path, as_of=AS_OF, max_rows=0, hot_keys=1)
    assert [r["transaction_id"] for r in rows_of(bucket, "A")] == [
        r["transaction_id"] for r in rows
    ]
    assert summary_of(bucket, "A")["counts"]["rejected_critical"] == 2
    assert len(rows_of(bucket, "B")) == 1


def test_a_summary_has_one_form_at_any_size(spark, bucket):
    bad = [row(transaction_id=f"T{i}", amount="") for i in range(20_001)]
    lost = [
        row(transaction_type="refund", amount="-1", related_transaction_id=f"NOPE-{i}")
        for i in range(300)
    ]
    bucket.csv(name("A"), row(transaction_id="Z", amount="0"), *bad, *lost)
    bucket.csv(name("B"), row(amount=""))
    process_incoming(spark, bucket.path, as_of=AS_OF)
    doc = summary_of(bucket, "A")
    ids = [x["transaction_id"] for x in doc["exceptions"]]
    assert ids == [*[f"T{i}" for i in range(20_001)], "Z", *[BASE["transaction_id"]] * 300]
    assert doc["counts"]["rejected_critical"] == 20_301
    # Each row has its own entry, and the id's entries stand once.
    assert [[v["rule"] for v in x["violations"]] for x in doc["exceptions"][-300:]] == [
        ["duplicate_transaction", "orphaned_refund"]
    ] * 300
    assert len(doc["shared_violations"]) == 300
    assert len(summary_of(bucket, "B")["exceptions"]) == 1
    # A later, clean version leaves nothing of the former one.
    bucket.csv(name("A"), row())
    process_incoming(spark, bucket.path, as_of=AS_OF, keys=[f"incoming/{name('A')}"])
    doc = summary_of(bucket, "A")
    assert doc["exceptions"] == doc["shared_violations"] == []
    assert sorted(os.listdir(f"{bucket.path}/processed/batch=A")) == [
        "object=summary.json",
        "object=transactions.csv",
    ]


def test_line_breaks_inside_quotes(spark, bucket):
    text = ",".join(row(merchant_name='"two\nlines"').values())
    bucket.put(name("A"), ",".join(S.TRANSACTION_COLUMNS) + "\n" + text + "\n")
    process_incoming(spark, bucket.path, as_of=AS_OF, multi_line=True)
    assert rows_of(bucket, "A")[0]["merchant_name"] == "twolines"


def test_listing(spark, bucket):
    bucket.csv(name("A"), row())
    [file] = list_incoming(spark, bucket.path).collect()
    assert file.source_key == f"incoming/{name('A')}"
    assert file.size_bytes == os.path.getsize(f"{bucket.path}/{file.source_key}")
    plan = list_incoming(spark, bucket.path)._jdf.queryExecution().toString()
    assert "content" not in plan.split("Physical Plan")[1]


def test_events_as_the_listing(spark, bucket):
    from batchgate.sources import explode_events

    bucket.csv(name("A"), row())
    bucket.csv(name("B"), row())
    event = {
        "Records": [
            {"s3": {"bucket": {"name": "b"}, "object": {"key": f"incoming/{name('A')}", "size": 9}}},
            {"s3": {"bucket": {"name": "b"}, "object": {"key": "incoming/junk.csv"}}},
        ]
    }
    events = spark.createDataFrame([(json.dumps(event),), ("{}",)], "event_json string")
    files = explode_events(events).withColumnRenamed("position", "arrival_seq")
    assert [(r.size_bytes) for r in files.orderBy("arrival_seq").collect()] == [9, 0]
    keys = [r.source_key for r in files.collect()]
    result = process_incoming(spark, bucket.path, as_of=AS_OF, files=files, keys=keys)
    assert {r.disposition for r in result.files.collect()} == {"accepted", "rejected_filename"}
    assert len(rows_of(bucket, "A")) == 1 and rows_of(bucket, "B") is None


def test_only_admitted_files_are_published(spark, bucket):
    bucket.csv(name("LISTED"), row())
    bucket.csv(name("UNLISTED"), row())
    keys = [f"incoming/{name('LISTED')}", f"incoming/{name('GONE')}", None]
    files = spark.createDataFrame(
        [("b", key, 9, i) for i, key in enumerate(keys)],
        "bucket string, source_key string, size_bytes long, arrival_seq long",
    )
    result = process_incoming(spark, bucket.path, as_of=AS_OF, files=files)
    assert {r.source_key: r.disposition for r in result.files.collect()} == {
        keys[0]: "accepted",
        keys[1]: "failed",
        None: "failed",
    }
    assert {r.source_key: r.error for r in result.dead_letters().collect()} == {
        keys[1]: "object is missing or cannot be read",
        None: "notification names no object",
    }
    assert result.alerts().count() == 0
    assert len(rows_of(bucket, "LISTED")) == 1
    for batch in ("UNLISTED", "GONE"):
        assert rows_of(bucket, batch) is None and summary_of(bucket, batch) is None


def test_an_unreadable_file_after_an_accepted_one_is_reprocessing(spark, bucket):
    bucket.csv(name("A", "2024-02-13"), row(), mtime=1000)
    bucket.put(name("A", "2024-02-14"), b"\xff\xfe", mtime=2000)
    result = process_incoming(spark, bucket.path, as_of=AS_OF)
    files = {r.file_date: r for r in result.files.collect()}
    assert [(files[d].reprocessing, files[d].superseded) for d in sorted(files)] == [
        (False, False),
        (True, False),
    ]
    assert [a.subject.split(": ")[1] for a in result.alerts().collect()] == [
        "Reprocessing Detected",
        "Rejected File",
    ]


def test_a_run_without_readable_files(spark, bucket):
    bucket.csv("junk.csv", row())
    result = process_incoming(spark, bucket.path, as_of=AS_OF)
    assert result.alerts().count() == 1
    assert K.processed_batches(spark, result.processed).count() == 0
