"""Every registered query equals its SQL."""

import pytest

import __spark_entry__ as registered
from checks import oracles
from checks import queries as own
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", own.queries())
def test_query(spark, con, name):
    ok, note = compare(spark, con, SF, name)
    assert ok, note


def test_every_query_has_sql():
    assert set(own.queries()) == set(oracles.oracle_sql())


def test_entry(spark):
    assert registered.entry(spark).count() == 2
