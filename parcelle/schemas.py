"""Schemas of the raw envelope, the two payloads and the unified table."""

from __future__ import annotations

from pyspark.sql import types as T

from parcelle import fixed_values as V

RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
])

RAW = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("ingest_ts", T.TimestampType()),
])

PAYLOAD_A = T.StructType([T.StructField(name, T.StringType()) for name in V.PAYLOAD_A])

PAYLOAD_M = T.StructType([
    T.StructField(name, T.DoubleType() if name == "price" else T.StringType())
    for name in V.PAYLOAD_M
])

TEXT_LIST = T.ArrayType(T.StringType())
TEXT_MAP = T.MapType(T.StringType(), T.StringType())

# Every unified column is text but for these.
_SILVER_TYPES = {
    "ingest_ts": T.TimestampType(),
    "price": T.DoubleType(),
    "images": TEXT_LIST,
    "equipments": TEXT_LIST,
    "offre_match": T.BooleanType(),
}
SILVER = T.StructType([
    T.StructField(name, _SILVER_TYPES.get(name, T.StringType()), nullable=name != "site")
    for name in V.SILVER_COLUMNS
])

# File tables have no hidden day partitioning, so the day is a column of its own.
PARTITION = T.StructField("ingest_date", T.DateType())


def only(schema: T.StructType, *names: str) -> T.StructType:
    """The named fields of a schema, for parsing no more JSON than a query reads."""
    return T.StructType([schema[name] for name in names])
