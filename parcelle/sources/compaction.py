"""Closed days of a raw folder in few files.

A stream writes files at every trigger, thousands a day. A closed day is written again into few
files, in a folder of its own beside the raw one, and becomes valid by one line in a list of closed
days. A reader takes the list first, and then every day from one place only: what it plans
before a day is on the list reads the old files, which stay until a retention of the
raw folder's own removes them. A rewrite that fails leaves a folder that no line names.
"""

from __future__ import annotations

import datetime as dt
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.operators.versions import fresh_window
from parcelle.schemas import PARTITION, RAW

#: Rows of a file, about: a few hundred bytes each.
ROWS_OF_A_FILE = 500_000
_LINE = "day DATE, folder STRING, rows BIGINT, written TIMESTAMP"


def _beside(path: str) -> str:
    return f"{path.rstrip('/')}_closed"


def closed_days(spark: SparkSession, path: str) -> dict[dt.date, str]:
    """The folder of each closed day; a day that was closed again counts by its last line. A line for each day, so few."""
    try:
        lines = spark.read.schema(_LINE).json(f"{_beside(path)}/list")
        last = lines.groupBy("day").agg(F.max_by("folder", "written").alias("folder")).collect()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        last = []
    return {r["day"]: r["folder"] for r in last}


def _stream_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T.StructType([*RAW.fields, PARTITION])).parquet(path)


def close_days(spark: SparkSession, path: str, before: dt.date, rows_of_a_file: int = ROWS_OF_A_FILE) -> list[dt.date]:
    """Writes the days before a date again that are not closed yet, and gives them.

    Rows are dated by their arrival, so a day gets none after it is over; leave the stream
    an hour or so to write what it had read.
    """
    done = closed_days(spark, path)
    raw = _stream_days(spark, path)
    day = F.col(PARTITION.name)
    counts = raw.where(day < F.lit(before)).groupBy(day.alias("day")).count().collect()  # a row for each day
    closed = []
    for found, rows in sorted((r["day"], r["count"]) for r in counts):
        if found in done:
            continue
        folder = f"{_beside(path)}/days/{found}-{uuid4()}"
        files = max(1, -(-rows // rows_of_a_file))
        # Dealt out by arrival, so that a file is a stretch of the day and time filters skip files.
        (raw.where(day == F.lit(found)).drop(PARTITION.name)
         .repartitionByRange(files, "ingest_ts", F.xxhash64("id", "payload")).write.parquet(folder))
        written = spark.read.schema(RAW).parquet(folder).count()
        if written != rows:
            raise RuntimeError(f"{found} changed while it was closed: {rows} rows, then {written}")
        line = spark.createDataFrame([(found, folder, rows)], "day DATE, folder STRING, rows BIGINT")
        line.withColumn("written", F.current_timestamp()).coalesce(1).write.mode("append").json(f"{_beside(path)}/list")
        closed.append(found)
    return closed


def scan_raw(spark: SparkSession, path: str, minutes: int = 0, as_of: dt.datetime | Column | None = None) -> DataFrame:
    """Raw envelopes of a folder, closed days from their few files; the last ``minutes`` only, if given."""
    done = closed_days(spark, path)
    raw = fresh_window(_stream_days(spark, path), minutes, as_of)
    if not done:
        return raw.drop(PARTITION.name)
    # NULL days, of rows without an arrival, are never closed.
    open_days = raw.where(~F.coalesce(F.col(PARTITION.name).isin(list(done)), F.lit(False))).drop(PARTITION.name)
    closed = spark.read.schema(RAW).parquet(*done.values())
    return open_days.unionByName(fresh_window(closed, minutes, as_of))
