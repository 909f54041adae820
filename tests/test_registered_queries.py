"""Every registered query against its SQL on an independent engine."""

import pytest

import __spark_entry__ as driver
from compare import connect, difference
from wardlens.plans import catalog

QUERIES, CHECKS = catalog.queries(), catalog.checks()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(driver.queries())
    assert set(CHECKS) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, folder, con, name):
    assert difference(QUERIES[name](spark, folder), con, CHECKS[name]) is None


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() == 48
