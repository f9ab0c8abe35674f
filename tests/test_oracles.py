"""Every registered query against its SQL on the smallest test data."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_its_sql(spark, con, name):
    assert compare(spark, con, name, FOLDER) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
