"""Corpus queries that SQL can express give the rows of their SQL."""

import duckdb
import pytest

from parcelle.llm.queries import CHECKS, QUERIES


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_same_rows(spark, sf_dir, name):
    engine = duckdb.connect()
    for table in ("documents", "benchmark"):
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = engine.execute(CHECKS[name]).df()
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(want[columns].itertuples(index=False, name=None)) and len(want)
