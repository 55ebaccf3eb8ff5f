"""Every query that has SQL returns the same rows as DuckDB."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    sql = oracle_sql().get(name)
    if sql:
        assert difference(df, con, sql) is None
    else:
        assert df.count() > 0


def test_oracle_names():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
