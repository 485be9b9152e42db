"""Every registered query against DuckDB on the smallest given tables."""

import pytest
from compare import DATA, connect, difference

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, name):
    assert difference(queries()[name](spark, SF_DIR), oracle_sql()[name], duck) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_runs_without_sql(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())


def test_difference_sees_differences(spark, duck):
    df = spark.sql("SELECT 1.0D AS a, 'x' AS b")
    assert difference(df, "SELECT 1.0::DOUBLE AS a, 'x' AS b", duck) is None
    assert difference(df, "SELECT 1.5::DOUBLE AS a, 'x' AS b", duck)
    assert difference(df, "SELECT 1.0::DOUBLE AS a, 'x' AS c", duck)
    assert difference(df, "SELECT 1.0::DOUBLE AS a, 'x' AS b UNION ALL SELECT 1, 'x'", duck)


def test_flagship(spark):
    result = entry(spark)
    assert result.columns[-2:] == ["revenue_rank", "revenue_dense_rank"]
    assert result.filter("revenue_rank = 1").count() >= 1
