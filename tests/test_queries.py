"""Every named query gives the rows of its checking SQL."""

import pytest
from pyspark.sql import types as T

import __spark_entry__ as contract
from parcelle.queries import CHECKS, QUERIES
from compare import checking_engine, rows_of_check, rows_of_spark


@pytest.fixture(scope="module")
def engine():
    from conftest import SF
    return checking_engine(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, engine, sf_dir, name):
    columns, rows = rows_of_spark(spark, name, sf_dir)
    check_columns, check_rows = rows_of_check(engine, name)
    assert columns == check_columns
    assert rows == check_rows


def test_every_query_is_checked():
    assert QUERIES.keys() == CHECKS.keys()
    assert QUERIES.keys() <= contract.queries().keys() and CHECKS.keys() <= contract.oracle_sql().keys()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["offre", "avg_price"]
    assert df.schema["avg_price"].dataType == T.DoubleType()
    assert df.count() == 2
