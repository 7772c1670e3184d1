"""Row and whole-file rules, each case a file of its own in one batch run."""

import pytest
from conftest import AS_OF, BASE, row
from pyspark.sql import functions as F

from batchgate.operators import batch as B
from batchgate.operators.rows import ROW_RULES, RowRule
from batchgate.schema import WARNING

BLANK_ALL = dict.fromkeys(["transaction_id", "account_id", "amount", "transaction_date"], "")
REFUND = dict(transaction_type="refund", amount="-5.00")

# name -> (rows, per row the expected (rule, ...) list)
CASES = {
    "clean": ([row()], [()]),
    "blank_account": ([row(account_id="")], [("missing_required_field",)]),
    "blank_amount": ([row(amount="")], [("missing_required_field",)]),
    "blank_date": ([row(transaction_date="")], [("missing_required_field",)]),
    "bad_amount": ([row(amount="not-a-number")], [("missing_required_field",)]),
    "bad_date": ([row(transaction_date="not-a-date")], [("missing_required_field",)]),
    "absent_account": ([row(account_id=None)], [("missing_required_field",)]),
    "blank_posted": ([row(posted_date="")], [("date_logic_violation",)]),
    "unknown_status": ([row(status="not_a_real_status")], [("invalid_enum_value",)]),
    "unknown_currency": ([row(currency="XXX")], [("invalid_enum_value",)]),
    "both_unknown": ([row(status="s", currency="XXX")], [("invalid_enum_value",)]),
    "status_case": ([row(status="Completed")], [("invalid_enum_value",)]),
    "absent_status": ([row(status=None)], [("invalid_enum_value",)]),
    "early_posting": ([row(posted_date="2024-02-09")], [("date_logic_violation",)]),
    "future": (
        [row(transaction_date="2024-02-16", posted_date="2024-02-16")],
        [("date_logic_violation",)],
    ),
    "negative_purchase": ([row(amount="-25.00")], [("amount_sign_mismatch",)]),
    "positive_refund": (
        [row(transaction_type="refund")],
        [("amount_sign_mismatch", "orphaned_refund")],
    ),
    "negative_transfer": ([row(transaction_type="transfer", amount="-25.00")], [()]),
    "failed_amount": ([row(status="failed")], [("status_amount_inconsistency",)]),
    "failed_zero": ([row(status="failed", amount="0.00")], [("zero_value_transaction",)]),
    "zero": ([row(amount="0.00")], [("zero_value_transaction",)]),
    "minus_zero": ([row(amount="-0.00")], [("zero_value_transaction",)]),
    "unknown_type": ([row(transaction_type="gift", amount="-3")], [()]),
    "nan": ([row(amount="nan")], [()]),
    "nan_failed": ([row(amount="nan", status="failed")], [("status_amount_inconsistency",)]),
    "duplicates": ([row(), row()], [("duplicate_transaction",)] * 2),
    "two_ids": ([row(), row(transaction_id="T2")], [(), ()]),
    "linked_refund": (
        [row(), row(transaction_id="T2", related_transaction_id=BASE["transaction_id"], **REFUND)],
        [(), ()],
    ),
    "lost_refund": (
        [row(related_transaction_id="TXN-DOES-NOT-EXIST", **REFUND)],
        [("orphaned_refund",)],
    ),
    "absent_related": (
        [row(related_transaction_id=None, **REFUND)],
        [("orphaned_refund",)],
    ),
    "refers_to_unsound": (
        [
            row(account_id=""),
            row(transaction_id="T2", related_transaction_id=BASE["transaction_id"], **REFUND),
        ],
        [("missing_required_field",), ()],
    ),
    "refers_to_itself": (
        [row(related_transaction_id=BASE["transaction_id"], **REFUND)],
        [()],
    ),
    "all_blank": ([row(**BLANK_ALL)], [("missing_required_field",) * 4]),
    "one_of_two_unsound": ([row(), row(amount="")], [(), ("missing_required_field",)]),
    "two_lost_twins": (
        [row(related_transaction_id="NOPE", **REFUND)] * 2,
        [("duplicate_transaction", "orphaned_refund")] * 2,
    ),
    "purchase_and_lost_twin": (
        [row(), row(related_transaction_id="NOPE", **REFUND)],
        [("duplicate_transaction",), ("duplicate_transaction", "orphaned_refund")],
    ),
    "blank_ids": (
        [row(transaction_id=""), row(transaction_id="")],
        [("missing_required_field",)] * 2,
    ),
    "mixed": (
        [row(), row(transaction_id="T2", amount="0.00"), row(transaction_id="T3", amount="")],
        [(), ("zero_value_transaction",), ("missing_required_field",)],
    ),
}


@pytest.fixture(scope="module")
def judged(spark):
    from batchgate import schema as S

    data = [
        (name, i, *[r[c] for c in S.TRANSACTION_COLUMNS])
        for name, (rows, _) in CASES.items()
        for i, r in enumerate(rows)
    ]
    ddl = "source_key string, row_seq bigint, " + ", ".join(
        f"{c} string" for c in S.TRANSACTION_COLUMNS
    )
    result = B.validate_batch(spark.createDataFrame(data, ddl), AS_OF)
    found = {(r.source_key, r.row_seq): r for r in result.exceptions().collect()}
    counts = {r.source_key: r for r in result.summary().collect()}
    valid = {(r.source_key, r.row_seq): r for r in result.valid_rows().collect()}
    return result, found, counts, valid


@pytest.mark.parametrize("name", CASES)
def test_rules(judged, name):
    _, found, counts, valid = judged
    rows, expected = CASES[name]
    severity = {r.name: r.severity for r in ROW_RULES}
    rejected = flagged = 0
    for i, want in enumerate(expected):
        entry = found.get((name, i))
        got = tuple(v.rule for v in entry.violations) if entry else ()
        assert got == want
        critical = any(severity.get(rule) != WARNING for rule in want)
        rejected += critical
        flagged += bool(want) and not critical
        assert ((name, i) in valid) == (not critical)
        if entry:
            assert entry.transaction_id == (rows[i]["transaction_id"] or "UNKNOWN")
            assert all(
                (v.severity == WARNING) == (severity.get(v.rule) == WARNING)
                for v in entry.violations
            )
    c = counts[name]
    assert (c.total_rows, c.passed, c.rejected_critical, c.flagged_warning_only) == (
        len(rows),
        len(rows) - rejected,
        rejected,
        flagged,
    )


def details(judged, name, i=0):
    return [v.detail for v in judged[1][(name, i)].violations]


@pytest.mark.parametrize(
    "name, want",
    [
        ("blank_account", ["Required field 'account_id' is blank."]),
        ("bad_amount", ["amount value 'not-a-number' does not parse as a number."]),
        ("bad_date", ["transaction_date value 'not-a-date' is not a valid date."]),
        ("blank_posted", ["posted_date is missing or unparseable."]),
        ("early_posting", ["posted_date precedes transaction_date."]),
        ("future", ["transaction_date is in the future."]),
        ("unknown_status", ["status 'not_a_real_status' not recognized."]),
        ("unknown_currency", ["currency 'XXX' not recognized."]),
        ("both_unknown", ["status 's' not recognized."]),
        ("absent_status", ["status 'None' not recognized."]),
        ("negative_purchase", ["Negative amount on purchase."]),
        ("failed_amount", ["status is 'failed' but amount is nonzero."]),
        ("zero", ["amount is 0.00."]),
        ("duplicates", ["transaction_id appears 2 times in the file."]),
        ("lost_refund", ["related_transaction_id 'TXN-DOES-NOT-EXIST' not found in file."]),
        (
            "positive_refund",
            ["Positive amount on refund.", "related_transaction_id '' not found in file."],
        ),
    ],
)
def test_details(judged, name, want):
    assert details(judged, name) == want


def test_valid_rows_keep_their_text(judged):
    kept = judged[3][("clean", 0)]
    assert kept.amount == BASE["amount"]
    assert kept.transaction_date == BASE["transaction_date"]


def test_structural_failures_come_first(batch):
    result = B.validate_batch(batch(row(amount="0.00"), row(transaction_id="T2", amount="")), AS_OF)
    ordered = result.exceptions().orderBy("ok", "row_seq").collect()
    assert [r.transaction_id for r in ordered] == ["T2", BASE["transaction_id"]]


def test_files_are_judged_apart(batch):
    result = B.validate_batch(batch(a=[row()], b=[row()]), AS_OF)
    assert result.exceptions().count() == 0


def test_files_without_rows_count_zero(spark, batch):
    files = spark.createDataFrame([("a",), ("b",)], "source_key string")
    got = {r.source_key: r for r in B.validate_batch(batch(a=[row()]), AS_OF).summary(files).collect()}
    assert got["a"].total_rows == 1
    assert got["b"].total_rows == got["b"].passed == got["b"].rejected_critical == 0


def test_a_rule_can_be_added(batch):
    shout = RowRule(
        "loud_merchant",
        WARNING,
        lambda as_of: F.when(F.col("merchant_name").rlike("^[A-Z ]+$"), F.lit("all capitals")),
    )
    rows = batch(row(merchant_name="ACME"), row(transaction_id="T2"))
    result = B.validate_batch(rows, AS_OF, (*ROW_RULES, shout))
    assert [(r.transaction_id, r.rule) for r in result.exceptions_long().collect()] == [
        (BASE["transaction_id"], "loud_merchant")
    ]


def test_absent_columns_are_null(batch):
    result = B.validate_batch(batch(row()).drop("posted_date", "merchant_name"), AS_OF)
    assert [r.rule for r in result.exceptions_long().collect()] == ["date_logic_violation"]


def test_a_repeated_id_lists_its_orphans_once(batch):
    lost = [row(related_transaction_id=f"NOPE-{i}", **REFUND) for i in range(5)]
    result = B.validate_batch(batch(*lost, row(transaction_id="T2")), AS_OF)
    rows = result.exceptions().orderBy("row_seq").collect()
    assert [r.shared for r in rows] == [True] * 5
    # Each row shows its own entry; the list common to all five is kept once.
    assert [[v.rule for v in r.violations] for r in rows] == [
        ["duplicate_transaction", "orphaned_refund"]
    ] * 5
    common = result.shared_violations().orderBy("row_seq").collect()
    assert [r.detail for r in common] == [
        f"related_transaction_id 'NOPE-{i}' not found in file." for i in range(5)
    ]
    assert {r.transaction_id for r in common} == {BASE["transaction_id"]}
