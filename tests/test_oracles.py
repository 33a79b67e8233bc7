"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate), plus the entry smoke check at sf0.001."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF01
from tests.oracle import compare, duck

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_every_query_has_oracle_or_is_listed():
    assert set(QUERIES) == set(ORACLES) | E.without_sql()
    assert not set(ORACLES) & E.without_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF01).toPandas(), con.execute(ORACLES[name]).fetchdf())
    assert res["ok"], res
