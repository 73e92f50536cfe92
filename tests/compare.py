"""Runs a named query and its checking SQL and compares the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from parcelle.queries import CHECKS, QUERIES
from parcelle.queries.inputs import TABLES


def checking_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of_spark(spark: SparkSession, name: str, sf_dir: str):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    return columns, Counter(
        tuple(_plain(v) for v in row) for row in df.select(*columns).collect()
    )


def rows_of_check(con: duckdb.DuckDBPyConnection, name: str):
    relation = con.execute(CHECKS[name])
    names = [d[0] for d in relation.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(
        tuple(_plain(row[i]) for i in order) for row in relation.fetchall()
    )
