"""Every registered query against its oracle SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from lotledger.plans import catalog
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()
# The smallest tables hold no such lot.
MAY_BE_EMPTY = {"missing_stabilized", "unit_rows", "complete_history_totals",
                "complete_history_lots", "exempt_lots_as_run", "exempt_lots"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_names():
    assert set(ORACLE) <= set(QUERIES)
    assert set(catalog.queries()) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, con, name):
    result = compare(spark, con, SF, QUERIES[name], ORACLE[name])
    assert result is None or (result == "EMPTY" and name in MAY_BE_EMPTY)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[0] == "ucbbl" and df.count() > 0
