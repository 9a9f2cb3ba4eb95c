"""Every registered query against its SQL, row for row."""

import os

import pytest

from testbed.compare import database, differences
from testbed.oracle import ORACLE
from testbed.queries import QUERIES

SF_DIR = os.environ.get("GRIDLAKE_TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    _, found = differences(QUERIES[name](spark, SF_DIR), db, ORACLE[name])
    assert not found, found[:5]


def test_entry_gives_rows(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns[:3] == ["date", "timestamp", "zone"] and df.columns[-1] == "price_7d_mean"
    assert not df.isEmpty()
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
