"""Every query against its SQL on the small tables: columns, types and all rows."""

import compare
import pytest

import __spark_entry__ as contract
import retail_oracle
import retail_queries

SF = "/root/testdata/sf0.001"
QUERIES = retail_queries.queries()
SQL = retail_oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, con):
    assert compare.differences(QUERIES[name](spark, SF), con, SQL[name]) == []


def test_the_contract_has_them_all():
    assert set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert "is_outlier" in df.columns
