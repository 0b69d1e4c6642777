"""Every registered query against its SQL answer."""

import pytest

import __spark_entry__ as entry
from kelda.plans import ALL_QUERIES, ALL_SQL
from tests.oracle import connect, differences

QUERIES, ANSWERS = ALL_QUERIES, ALL_SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ANSWERS)
    assert QUERIES.items() <= entry.queries().items()
    assert ANSWERS.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), ANSWERS[name], con) == []


def test_entry(spark):
    result = entry.entry(spark)
    assert set(result.columns) == {"period", "r_name", "revenue", "orders"}
    assert result.count() > 0


def test_comparison_notices_differences(spark, con):
    one = spark.sql("SELECT 1L AS a, 'x' AS b")
    assert differences(one, "SELECT CAST(1 AS BIGINT) AS a, 'x' AS b", con) == []
    assert differences(one, "SELECT CAST(2 AS BIGINT) AS a, 'x' AS b", con)
    assert differences(one, "SELECT 1 AS a, 'x' AS b", con)
    assert differences(one, "SELECT CAST(1 AS BIGINT) AS a", con)
