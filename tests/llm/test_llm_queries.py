"""Registered queries that SQL can express equal their SQL."""

import pytest

import __spark_entry__ as registered
from batchgate.llm import license_scan
from batchgate.llm import queries as own
from checks.compare import compare, connect

from .conftest import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", own.oracle_sql())
def test_sql(spark, con, name):
    ok, note = compare(spark, con, SF, name)
    assert ok, note


def test_registered():
    names = set(registered.queries())
    assert set(own.queries()) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in own.queries()} == set(range(1, 14))


def test_index_as_in_sql(spark):
    got = {(r["template"], r["word"], r["at"], r["weight"]) for r in license_scan.index(spark).collect()}
    want = {tuple(p[k] for k in ("template", "word", "at", "weight")) for p in license_scan.listed_postings()}
    assert got == want


def test_license_odd(spark, odd, nothing):
    rows = {r["doc_id"]: r for r in license_scan.scan(odd).collect()}
    assert license_scan.scan(odd).count() == odd.count()
    mit = rows[14]
    assert (mit["n_words"], mit["n_base"], mit["first_word"], mit["last_word"]) == (7, 3, 0, 5)
    assert (mit["base_labels"], mit["score"]) == ("mit", 1.0)
    assert rows[15]["labels"] == "gpl,gpl-3.0"
    assert (rows[1]["n_words"], rows[1]["first_word"], rows[1]["labels"]) == (0, None, "")
    assert license_scan.scan(nothing).count() == 0
