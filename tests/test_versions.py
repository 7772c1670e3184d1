"""Versions of batches: commits are whole, and only what is committed counts."""

import os
from datetime import datetime, timezone

import pytest
from conftest import AS_OF, row

from batchgate import schema as S
from batchgate.operators import gate as G
from batchgate.operators.batch import validate_batch
from batchgate.plans import pipeline as P
from batchgate.plans import process_incoming
from batchgate.sinks import versions as V
from batchgate.sources import explode_events, list_incoming

NAME = "transactions_2024-02-14_{}.csv"


def merchants(spark, bucket):
    back = V.read_transactions(spark, f"{bucket.path}/processed", S.TRANSACTION_COLUMNS)
    found = {}
    for r in back.collect() if back is not None else []:
        found.setdefault(r.batch, []).append(r.merchant_name)
    return {b: sorted(x for x in m) for b, m in found.items()}


def run(spark, bucket, **options):
    return process_incoming(spark, bucket.path, as_of=AS_OF, versioned=True, **options)


def test_a_run_that_ends_early_leaves_the_former_version(spark, bucket, monkeypatch):
    for batch in "AB":
        bucket.csv(NAME.format(batch), row(merchant_name="old"), row(transaction_id="bad", amount=""))
    run(spark, bucket, run_id="one")
    assert merchants(spark, bucket) == {"A": ["old"], "B": ["old"]}
    summaries = V.read_summaries(spark, f"{bucket.path}/processed").collect()

    bucket.csv(NAME.format("A"), row(merchant_name="new"))
    bucket.csv(NAME.format("C"), row(merchant_name="new"))
    with monkeypatch.context() as patch:

        def killed(*_, **__):
            raise RuntimeError("killed between rows and summaries")

        patch.setattr(V, "write_summaries", killed)
        with pytest.raises(RuntimeError):
            run(spark, bucket, run_id="two")
        patch.undo()
        patch.setattr(V, "_append", killed)
        with pytest.raises(RuntimeError):
            run(spark, bucket, run_id="two")
    assert merchants(spark, bucket) == {"A": ["old"], "B": ["old"]}
    assert V.read_summaries(spark, f"{bucket.path}/processed").collect() == summaries

    again = run(spark, bucket, run_id="two")
    assert merchants(spark, bucket) == {"A": ["new"], "B": ["old"], "C": ["new"]}
    assert {r.source_key[-5]: r.reprocessing for r in again.files.collect()} == {"A": True, "B": True, "C": False}
    # A committed run is not written again.
    before = len(V.entries(spark, f"{bucket.path}/processed"))
    run(spark, bucket, run_id="two")
    assert len(V.entries(spark, f"{bucket.path}/processed")) == before


def test_output_in_place_is_blank_until_the_run_ends(spark, bucket, monkeypatch):
    bucket.csv(NAME.format("A"), row(merchant_name="old"))
    process_incoming(spark, bucket.path, as_of=AS_OF)
    assert bucket.read("A", "summary.json").startswith("{")

    def killed(*_, **__):
        raise RuntimeError

    monkeypatch.setattr(P, "write_transactions", killed)
    with pytest.raises(RuntimeError):
        process_incoming(spark, bucket.path, as_of=AS_OF)
    assert bucket.read("A", "summary.json").strip() == ""
    finished = P.processed_batches(spark, f"{bucket.path}/processed").collect()
    assert [(r.partner_batch_id, r.finished_at) for r in finished] == [("A", None)]


def pointer(spark, *rows):
    at = datetime(2024, 2, 15, tzinfo=timezone.utc)
    data = [(b, v, f"incoming/{b}.csv", at) for b, v in rows]
    return spark.createDataFrame(data, "partner_batch_id string, version string, source_key string, finished_at timestamp")


def test_the_latest_commit_counts_also_after_compaction(spark, tmp_path):
    out = str(tmp_path / "processed")
    assert V.current(spark, out).count() == 0
    for k in range(6):
        V.commit(spark, out, f"r{k}", pointer(spark, (f"b{k % 3}", f"v{k}"), ("x", f"v{k}")), compact_after=2)
    known = V.entries(spark, out)
    assert any(e.full for e in known) and len(known) <= 4
    found = {r.partner_batch_id: r.version for r in V.current(spark, out).collect()}
    assert found == {"b0": "v3", "b1": "v4", "b2": "v5", "x": "v5"}
    wanted = spark.createDataFrame([("b1",), ("none",), (None,)], "partner_batch_id string")
    assert [(r.partner_batch_id, r.version) for r in V.current(spark, out, wanted).collect()] == [("b1", "v4")]
    V.retire(spark, out, "gone", wanted)
    assert {r.partner_batch_id for r in V.current(spark, out).collect()} == {"b0", "b2", "x"}


def test_two_commits_do_not_take_one_number(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "processed")
    V.commit(spark, out, "one", pointer(spark, ("a", "1")))
    taken = V.entries(spark, out)
    # Another run commits after this one has looked at the log.
    stale = [taken[:0], *[None] * 9]
    look = V.entries
    monkeypatch.setattr(V, "entries", lambda *a: s if (s := stale.pop(0)) is not None else look(*a))
    assert V._append(spark, out, {"index": taken[0].index, "full": False, "run_id": "two"}) == 2
    assert V._append(spark, out, {"index": "none", "full": True, "run_id": "late"}, 2) == 0
    assert [e.run_id for e in look(spark, out)] == ["one", "two"]


def test_sweep_removes_what_counts_no_more(spark, bucket):
    for batch in "AB":
        bucket.csv(NAME.format(batch), row(merchant_name="old"))
    run(spark, bucket, run_id="one")
    bucket.csv(NAME.format("A"), row(merchant_name="new"))
    os.remove(f"{bucket.path}/incoming/{NAME.format('B')}")
    run(spark, bucket, run_id="two")
    processed = f"{bucket.path}/processed"
    assert V.sweep(spark, processed) == 1
    assert V.sweep(spark, processed) == 0
    assert merchants(spark, bucket) == {"A": ["new"], "B": ["old"]}
    V.retire(spark, processed, "retire", spark.createDataFrame([("B",)], "partner_batch_id string"))
    assert V.sweep(spark, processed) == 1
    assert merchants(spark, bucket) == {"A": ["new"]}


# --- objects of the listing ----------------------------------------------------


def test_listing_has_empty_and_hidden_objects(spark, bucket):
    os.makedirs(f"{bucket.path}/incoming/a b/_c")
    for name in ("x.csv", "_y.csv", ".z.csv", "a b/q%.csv", "a b/_c/r.csv"):
        bucket.put(name, "v")
    bucket.put("empty.csv", "")
    bucket.put("other.txt", "v")
    found = {r.source_key: r.size_bytes for r in list_incoming(spark, bucket.path).collect()}
    assert found == {f"incoming/{n}": 1 for n in ("x.csv", "_y.csv", ".z.csv", "a b/q%.csv", "a b/_c/r.csv")} | {"incoming/empty.csv": 0}
    keys = ["incoming/x.csv", "incoming/empty.csv", "incoming/gone.csv"]
    assert {r.source_key for r in list_incoming(spark, bucket.path, keys=keys).collect()} == set(keys[:2])


@pytest.mark.parametrize("versioned", [True, False])
def test_vanished_objects_leave_earlier_output(spark, bucket, versioned):
    bucket.csv(NAME.format("A"), row(merchant_name="old"))
    bucket.put(NAME.format("EMPTY"), "")
    processed = lambda **o: process_incoming(spark, bucket.path, as_of=AS_OF, versioned=versioned, **o)
    first = {r.source_key: r.disposition for r in processed().files.collect()}
    assert first == {f"incoming/{NAME.format(b)}": G.ACCEPTED for b in ("A", "EMPTY")}
    os.remove(f"{bucket.path}/incoming/{NAME.format('A')}")
    record = '{"s3":{"bucket":{"name":"b"},"object":{"key":"%s"}}}'
    keys = [f"incoming/{NAME.format(b)}" for b in ("A", "EMPTY")]
    event = '{"Records":[' + ",".join(record % k for k in keys) + "]}"
    events = explode_events(spark.createDataFrame([(event, 1)], "event_json string, arrival_seq int"))
    told = processed(files=events.drop("position"))
    assert {r.source_key: r.disposition for r in told.files.collect()} == dict(zip(keys, [G.FAILED, G.ACCEPTED]))
    assert [r.source_key for r in told.dead_letters().collect()] == keys[:1]
    # Named by key it is a dead letter as well, and the run goes on.
    named = {r.source_key: r.disposition for r in processed(keys=keys).files.collect()}
    assert named == dict(zip(keys, [G.FAILED, G.ACCEPTED]))
    if versioned:
        assert merchants(spark, bucket) == {"A": ["old"]}
    else:
        assert "old" in bucket.read("A", "transactions.csv")


# --- full lists ---------------------------------------------------------------


def expected_lists(rows):
    """The whole-file rules as they read for one row after another."""
    sound = [r for r in rows if r["account_id"]]
    ids = {r["transaction_id"] for r in rows}
    count = {}
    for r in sound:
        count[r["transaction_id"]] = count.get(r["transaction_id"], 0) + 1
    extra = {}
    for r in sound:
        own = extra.setdefault(r["transaction_id"], [])
        if count[r["transaction_id"]] > 1 and not own:
            own.append(("duplicate_transaction", f"transaction_id appears {count[r['transaction_id']]} times in the file."))
        if r["transaction_type"] == "refund" and r["related_transaction_id"] not in ids:
            own.append(("orphaned_refund", f"related_transaction_id '{r['related_transaction_id']}' not found in file."))
    found = []
    for i, r in enumerate(rows):
        if not r["account_id"]:
            found.append((i, 0, "missing_required_field", "Required field 'account_id' is blank."))
            continue
        own = [("zero_value_transaction", "amount is 0.00.")] if r["amount"] == "0.00" else []
        found += [(i, k, *v) for k, v in enumerate(own + extra.get(r["transaction_id"], []))]
    return sorted(found)


@pytest.mark.parametrize("at_once", [(4096, 1024), (7, 5)])
def test_full_lists(spark, batch, at_once):
    refund = {"transaction_type": "refund", "amount": "-1.00"}
    rows = [row(transaction_id=f"one-{k}", **refund, related_transaction_id=["", "gone"][k % 2] or "one-1") for k in range(4)]
    rows += [row(transaction_id="two", **refund, related_transaction_id=f"gone-{k}") for k in range(2)]
    rows += [row(transaction_id="pair"), row(transaction_id="pair", amount="0.00")]
    for k in range(1000):
        if k % 20 == 3:
            rows.append(row(transaction_id="many", **refund, related_transaction_id=f"lost-{k}"))
        elif k % 50 == 7:
            rows.append(row(transaction_id="many", account_id=""))
        else:
            rows.append(row(transaction_id="many", amount="0.00" if k % 3 else "1.00"))
    checked = validate_batch(batch(*rows), AS_OF)
    got = checked.exceptions_full(*at_once).select("row_seq", "pos", "rule", "detail").collect()
    assert sorted(tuple(r) for r in got) == expected_lists(rows)
