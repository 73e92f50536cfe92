"""Which versions of a listing count: the fresh, the latest, the addressable."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelle import fixed_values as V
from parcelle.functions.dates import utc_day
from parcelle.functions.text import has_text
from parcelle.schemas import PARTITION


def cut_off(minutes: int, as_of: dt.datetime | Column | None = None) -> Column:
    """The time ``minutes`` before ``as_of``, which is now unless given."""
    if as_of is None:
        end = F.current_timestamp()
    elif isinstance(as_of, Column):
        end = as_of
    else:
        end = F.lit(as_of)
    return F.timestamp_add("MINUTE", F.lit(-minutes), end)


def fresh_window(
    df: DataFrame,
    minutes: int = V.WINDOW_MINUTES,
    as_of: dt.datetime | Column | None = None,
    column: str = "ingest_ts",
) -> DataFrame:
    """Rows of the last ``minutes``, the cut-off included; all rows if not positive.

    Put before :func:`latest_per_key` it leaves the result as it is, because rows
    are ranked by the very column it filters, and it lets the scan skip files. On a
    day-partitioned file table the day is compared as well, which skips whole days.
    """
    if minutes <= 0:
        return df
    since = cut_off(minutes, as_of)
    kept = F.col(column) >= since
    if column == "ingest_ts" and PARTITION.name in df.columns:
        kept = kept & (F.col(PARTITION.name) >= utc_day(since))
    return df.filter(kept)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = ("id",),
    newest: str = "ingest_ts",
    ties: Sequence[str] = ("payload",),
    spread: int = 1,
) -> DataFrame:
    """The newest row of each key; of equally new ones the one greatest in ``ties``.

    The rank is cut to one, so Spark keeps a single row per key in every map task
    before the shuffle: a key with a third of all rows sends one row per task. Rows
    without a key are one group like any other.

    With ``spread`` above one the rows are ranked twice: among the tasks of each of so
    many shares, then among the shares. A key that every task sends a row of then
    meets in groups of (tasks / spread) and of (spread) rows, for a second shuffle of
    what the first rank left.
    """
    order = [F.col(name).desc_nulls_last() for name in (newest, *ties)]

    def first(rows: DataFrame, *by: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")

    if spread > 1:
        shared = df.withColumn("_share", F.spark_partition_id() % spread)
        df = first(shared, *keys, "_share").drop("_share")
    return first(df, *keys)


def spread_for(tasks: int, most_rows: int = 10_000) -> int:
    """Shares that keep every group of :func:`latest_per_key` small: none up to ``most_rows`` tasks, then the root of the tasks."""
    return 1 if tasks <= most_rows else math.ceil(math.sqrt(tasks))


def valid_url(df: DataFrame, column: str = "url") -> DataFrame:
    """Rows with an address that is neither missing nor blank."""
    return df.filter(has_text(F.col(column)))
