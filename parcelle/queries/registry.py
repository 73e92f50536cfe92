"""Registers named queries together with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str) -> Callable[[Query], Query]:
    """Register a function under its own name with its checking SQL."""
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        CHECKS[fn.__name__] = check
        return fn
    return register
