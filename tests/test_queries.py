"""Every registered query against its SQL on the smallest data; queries without SQL must give rows."""

import pytest
from check import compare, connect

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()
SLOW = {"h7_boosted_trees", "h8_parameter_search", "h13_feature_importance", "h15_all_backends", "i4_recursive_trees"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    result = compare(QUERIES[name](spark, SF).toPandas(), duck.execute(SQL[name]).df())
    assert result.startswith("ok"), result


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
