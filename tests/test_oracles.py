"""Every query with SQL gives the rows of its SQL, at the smallest scale."""

import pytest
from compare import connect, differences
from conftest import SF

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert set(entry.entry(spark).columns) == {"company_id", "date", "revenue", "expenditure"}
