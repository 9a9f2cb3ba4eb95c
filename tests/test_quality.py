import pytest

from gridlake.operators.quality import CONTRACTS, Contract, check_table, check_tables, duplicate_keys, failing_rows
from gridlake.sources.zones import zone_dimension

RULES = Contract(not_null=("k", "v"), unique=("k",), accepted_values={"v": ["a", "b"]}, accepted_range={"n": (1, 96)})


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [(1, "a", 1), (1, "b", 96), (2, "c", 0), (None, None, 97), (None, "a", None)], "k int, v string, n int")


def test_counts(df, rows):
    assert rows(check_table(df, RULES, "t"), "check_name", "column_name", "failures") == [
        ("accepted_range", "n", 2), ("accepted_values", "v", 1), ("not_null", "k", 2),
        ("not_null", "v", 1), ("unique", "k", 1)]


def test_failing_rows_name_their_rules(df, rows):
    got = {(r.k, r.v): r.failed for r in failing_rows(df, RULES).collect()}
    assert got == {
        (2, "c"): ["accepted_values:v", "accepted_range:n"],
        (None, None): ["not_null:k", "not_null:v", "accepted_range:n"],
        (None, "a"): ["not_null:k"]}


def test_duplicate_keys(df, rows):
    assert rows(duplicate_keys(df, "k")) == [(1, 2)]


def test_contracts_hold_25_rules():
    n = sum(len(c.not_null) + len(c.unique) + len(c.accepted_values) + len(c.accepted_range) for c in CONTRACTS.values())
    assert n == 25


def test_zone_list_keeps_its_contract(spark):
    report = check_tables({"dim_region_mapping": zone_dimension(spark)})
    assert [r.failures for r in report.collect()] == [0] * 4
    with pytest.raises(ValueError):
        check_tables({})
