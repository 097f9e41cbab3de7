"""Every registered query against its SQL on the smallest test tables."""

import os

import __spark_entry__ as contract
import comparing
import pytest

from ludolens import checks

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    connection = comparing.open_tables(FOLDER)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(checks.oracle_sql()) == set(checks.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(checks.queries()))
def test_query_equals_sql(spark, tables, name):
    ours = comparing.spark_bag(contract.queries()[name](spark, FOLDER))
    theirs = comparing.sql_bag(tables, contract.oracle_sql()[name])
    assert comparing.difference(ours, theirs) is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
