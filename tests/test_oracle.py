"""Every registered query against DuckDB on the small tables."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = connect(SF_DIR)
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    diff = compare(spark, con, SF_DIR, name, queries()[name], ORACLE.get(name))
    assert diff is None, diff


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(queries())


def test_entry(spark):
    from __spark_entry__ import entry

    out = entry(spark)
    assert out.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    assert out.count() == spark.read.parquet(f"{SF_DIR}/orders.parquet").count()
