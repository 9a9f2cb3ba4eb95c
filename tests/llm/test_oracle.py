"""Registered queries against their SQL, row for row."""

import os

import pytest

from gridlake.llm.queries import ORACLE, QUERIES
from testbed.compare import database, differences

SF_DIR = os.environ.get("GRIDLAKE_TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, name):
    n, found = differences(QUERIES[name](spark, SF_DIR), database(SF_DIR), ORACLE[name])
    assert n and not found, found[:3]
