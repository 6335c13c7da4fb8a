"""Every registered query with a SQL text gives the same rows as DuckDB."""

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from tools.check import connect, differences


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, duck, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    assert differences(got, duck.execute(entry.oracle_sql()[name]).df()) is None


def test_every_query_has_sql():
    """But the corpus operators that SQL cannot express, which have tests of their own."""
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert all(name == "pipeline" or name.startswith("op") and name[2].isdigit() for name in without)


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
