"""Every registered query against its SQL, and the contract of the entry module."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry_module
from spark_checks import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert name in ORACLES
    assert difference(QUERIES[name](spark, SMALL), con, ORACLES[name]) is None


def test_entry_module(spark):
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 5
    assert [r.n_arrivals for r in rows] == sorted((r.n_arrivals for r in rows), reverse=True)
