"""Every registered query beside its SQL."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_agrees_with_sql(spark, con, name):
    wrong = compare(entry.queries()[name](spark, SMALL), con, entry.oracle_sql()[name])
    # A filter may have nothing to find in the smallest tables.
    assert wrong in (None, "both empty"), wrong


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_has_rows(spark, name):
    assert entry.queries()[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
