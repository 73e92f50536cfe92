"""Raw and unified tables: creation, scans, writes, inspection.

Two providers: ``iceberg``, where a table is partitioned by the day of its time by
transform, and ``parquet``, where the day is a column that writers fill in.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import logging
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle import fixed_values as V
from parcelle.functions.dates import utc_day
from parcelle.operators.audits import Audit
from parcelle.operators.versions import fresh_window
from parcelle.schemas import PARTITION, RAW, SILVER

log = logging.getLogger(__name__)

ICEBERG = "iceberg"
PARQUET = "parquet"
PROVIDERS = (ICEBERG, PARQUET)

APPEND = V.APPEND
MERGE = "merge"
# What a version of a listing is told by.
VERSION = ("site", "id", "ingest_ts")


def table_name(*parts: str | None) -> str:
    """'catalog.namespace.table', without the parts that are missing."""
    return ".".join(part for part in parts if part)


# --- creation ----------------------------------------------------------------

def table_ddl(name: str, schema: T.StructType, provider: str = ICEBERG) -> str:
    """CREATE TABLE for a table partitioned by the day of ``ingest_ts``."""
    if provider == ICEBERG:
        return (
            f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING iceberg "
            "PARTITIONED BY (days(ingest_ts)) "
            f"TBLPROPERTIES ({', '.join(f"'{k}' = '{v}'" for k, v in V.ICEBERG_TABLE.items())})"
        )
    if provider == PARQUET:
        dated = T.StructType([*schema.fields, PARTITION])
        return (
            f"CREATE TABLE IF NOT EXISTS {name} ({dated.toDDL()}) USING parquet "
            f"PARTITIONED BY ({PARTITION.name})"
        )
    raise ValueError(f"unknown table provider: {provider}")


def create_namespace(spark: SparkSession, namespace: str, catalog: str | None = None) -> str:
    name = table_name(catalog, namespace)
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")
    return name


def create_raw_tables(
    spark: SparkSession,
    sources: Iterable[str],
    catalog: str | None = None,
    provider: str = ICEBERG,
) -> list[str]:
    """Raw tables of the named sources; unknown names are skipped with a warning."""
    namespace = create_namespace(spark, V.RAW_NAMESPACE, catalog)
    created = []
    for source in sources:
        site = source.strip().lower()
        if site not in V.SITES:
            log.warning("unknown source %r skipped, known are %s", source, ", ".join(V.SITES))
            continue
        name = table_name(namespace, site)
        spark.sql(table_ddl(name, RAW, provider))
        created.append(name)
    return created


def create_silver_table(
    spark: SparkSession, catalog: str | None = None, provider: str = ICEBERG
) -> str:
    namespace = create_namespace(spark, V.SILVER_NAMESPACE, catalog)
    name = table_name(namespace, V.SILVER_TABLE)
    spark.sql(table_ddl(name, SILVER, provider))
    return name


def create_typed_view(spark: SparkSession, table: str, view: str) -> None:
    """A view of a unified table with the date of publication as a time, ``published_at``, beside its text."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT *, try_to_timestamp(published_date, '{V.DATE_FORMAT}') AS published_at FROM {table}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


# --- inspection --------------------------------------------------------------

def namespaces(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW NAMESPACES IN {catalog}" if catalog else "SHOW NAMESPACES")


def tables(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE {name}")


def properties(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW TBLPROPERTIES {name}")


# --- scans -------------------------------------------------------------------

def scan(
    spark: SparkSession,
    name: str,
    minutes: int = 0,
    as_of: dt.datetime | Column | None = None,
) -> DataFrame:
    """A table, or its last ``minutes`` only, with the filter where the scan can use it."""
    return _without_partition(fresh_window(spark.table(name), minutes, as_of))


def scan_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW,
    minutes: int = 0,
    as_of: dt.datetime | Column | None = None,
) -> DataFrame:
    """A day-partitioned Parquet folder, such as the stream writes, read like a table."""
    dated = T.StructType([*schema.fields, PARTITION])
    files = spark.read.schema(dated).parquet(path)
    return _without_partition(fresh_window(files, minutes, as_of))


def _without_partition(df: DataFrame) -> DataFrame:
    return df.drop(PARTITION.name)


# --- writes ------------------------------------------------------------------

def write_silver(
    df: DataFrame,
    name: str,
    mode: str | None = APPEND,
    provider: str = ICEBERG,
    rebalance: bool = False,
    audit: Audit | None = None,
) -> None:
    """Append to a unified table, add what is new to it, or replace days of a site.

    ``merge`` leaves out versions that are there already, so that windows may overlap.
    The overwrite modes replace, of the days that the rows fall on, the rows of the
    sites they are of; the other sites' rows of these days are written again.

    ``rebalance`` shuffles once more so that each day ends up in few files of even
    size: for backfills over many days. A day with most of the rows is split over
    several tasks, so no writer gets it whole. ``audit`` counts what is written.
    """
    how = (mode or APPEND).lower()
    if how not in (APPEND, MERGE) and how not in V.OVERWRITE_MODES:
        raise ValueError(f"unsupported write mode: {mode}")
    table = df.sparkSession.table(name)
    more = [column for column in table.columns if column not in (*SILVER.names, PARTITION.name)]
    rows = unified_rows(df, more)
    if how == MERGE:
        rows, how = new_versions(rows, table), APPEND
    elif how != APPEND:
        rows = rows.unionByName(unified_rows(other_sites(rows, table), more))
    if audit:
        rows = audit.of_written(rows)
    if provider == ICEBERG:
        if rebalance:
            # No column: the table's days are a transform, and AQE evens out sizes.
            rows = rows.hint("rebalance")
        writer = rows.writeTo(name).options(**V.ICEBERG_WRITE)
        writer.append() if how == APPEND else writer.overwritePartitions()
    elif provider == PARQUET:
        dated = with_partition(rows)
        if rebalance:
            dated = dated.hint("rebalance", PARTITION.name)
        if how == APPEND:
            dated.write.insertInto(name)
        else:
            with dynamic_overwrite(df.sparkSession):
                dated.write.insertInto(name, overwrite=True)
    else:
        raise ValueError(f"unknown table provider: {provider}")


def _days(rows: DataFrame) -> DataFrame:
    return rows.select(utc_day(F.col("ingest_ts")).alias(PARTITION.name)).distinct()


def _dated(there: DataFrame) -> DataFrame:
    return there if PARTITION.name in there.columns else with_partition(there)


def new_versions(rows: DataFrame, there: DataFrame) -> DataFrame:
    """Rows whose version is not in the table, of which only the days of the rows are compared."""
    known = _dated(there).join(_days(rows), PARTITION.name, "left_semi").select(*VERSION)
    return rows.join(known, list(VERSION), "left_anti").select(*rows.columns)


def other_sites(rows: DataFrame, there: DataFrame) -> DataFrame:
    """The table's rows on the days of the given rows that are of sites with no row on that day."""
    sites = with_partition(rows).select(PARTITION.name, "site").distinct()
    same_days = _dated(there).join(_days(rows), PARTITION.name, "left_semi")
    return same_days.join(sites, [PARTITION.name, "site"], "left_anti")


@contextlib.contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Inserts replace the partitions they touch; no option of the writer says so."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def unified_rows(df: DataFrame, more: Iterable[str] = ()) -> DataFrame:
    """The unified columns in table order, then text columns that the table has, too; a missing value where there must be one fails."""
    there = set(df.columns)
    def column(field: T.StructField) -> Column:
        value = F.col(field.name)
        if not field.nullable:
            problem = F.raise_error(f"{field.name} must not be NULL").cast(field.dataType)
            value = F.coalesce(value, problem)
        return value.cast(field.dataType).alias(field.name)

    others = (F.col(n).cast("string").alias(n) if n in there else F.lit(None).cast("string").alias(n) for n in more)
    return df.select(*map(column, SILVER.fields), *others)


def with_partition(df: DataFrame) -> DataFrame:
    return df.withColumn(PARTITION.name, utc_day(F.col("ingest_ts")))
