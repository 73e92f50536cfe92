"""The newest row of each listing, kept as a table that grows by what changes.

The unified table is append-only, so the newest rows have to be found among all versions.
Here they are kept: one row for each site and id, in a Parquet table whose buckets are Spark's own
(hash of the key), each in a folder of its own. A scan has the partitioning that a window or join
by key asks for, so neither shuffles the table; a merge shuffles the new rows alone, and
writes again only the folders of buckets in which something is newer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle import fixed_values as V
from parcelle.operators.versions import latest_per_key
from parcelle.schemas import SILVER
from parcelle.sources import tables

BUCKETS = 256
#: Site and id in one column, so that one partitioning serves all; never NULL, so that joins find it.
KEY = T.StructField("listing_key", T.StringType(), nullable=False)
BUCKET = T.StructField("bucket", T.IntegerType())
#: What versions are compared by, as :func:`parcelle.plans.silver.latest_listings` does.
ORDER = ("ingest_ts", "url", "title")


def table_ddl(name: str, buckets: int = BUCKETS) -> str:
    columns = T.StructType([*SILVER.fields, KEY, BUCKET])
    return (
        f"CREATE TABLE IF NOT EXISTS {name} ({columns.toDDL()}) USING parquet "
        f"PARTITIONED BY ({BUCKET.name}) CLUSTERED BY ({KEY.name}) INTO {buckets} BUCKETS"
    )


def create_latest_table(spark: SparkSession, catalog: str | None = None, buckets: int = BUCKETS) -> str:
    """The table beside the unified one. Choose buckets for a few hundred megabytes each when it is full."""
    name = tables.table_name(tables.create_namespace(spark, V.SILVER_NAMESPACE, catalog), V.LATEST_TABLE)
    spark.sql(table_ddl(name, buckets))
    return name


def buckets_of(spark: SparkSession, name: str) -> int:
    found = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    if "Num Buckets" not in found:
        raise ValueError(f"not a bucketed table: {name}")
    return int(found["Num Buckets"])


def keyed(rows: DataFrame) -> DataFrame:
    """Unified rows with the key of the table."""
    key = F.concat(F.length("site"), F.lit(":"), F.col("site"), F.coalesce(F.concat(F.lit("="), F.col("id")), F.lit("")))
    return tables.unified_rows(rows).withColumn(KEY.name, key)


def _version(of: str) -> Column:
    """What a newer version is greater in; a missing value is least."""
    return F.struct(*(F.col(f"{of}.{name}") for name in ORDER))


def changed(there: DataFrame, rows: DataFrame) -> DataFrame:
    """Of the rows' newest versions those that the table does not have, or has an older one of."""
    # Merged in the table's order of buckets, however small the statistics say it is.
    old = there.select(KEY.name, *ORDER).withColumn("_old", F.lit(True)).hint("merge").alias("old")
    newer = F.col("_old").isNull() | (_version("new") > _version("old"))
    return (
        rows.alias("new").join(old, KEY.name, "left").where(newer)
        .select(KEY.name, *(F.col(f"new.{name}") for name in rows.columns if name != KEY.name))
    )


def merged(there: DataFrame, changes: DataFrame) -> DataFrame:
    """The table's rows, with the changes in place of what they are newer than. Either side has a key once."""
    names = [name for name in changes.columns if name != KEY.name]
    both = there.alias("old").join(changes.withColumn("_new", F.lit(True)).hint("merge").alias("new"), KEY.name, "full")
    return both.select(KEY.name, *(F.when(F.col("_new"), F.col(f"new.{n}")).otherwise(F.col(f"old.{n}")).alias(n) for n in names))


def merge(df: DataFrame, name: str) -> list[int]:
    """Brings the table up to date with unified rows of any kind, and gives the buckets it wrote again.

    Rows that are there already, or older than what is there, change nothing: merging
    the same rows again writes nothing.
    """
    spark = df.sparkSession
    buckets = buckets_of(spark, name)
    table = spark.table(name)
    # Cut to one row for each key first; then in the table's own partitioning, so that it stays where it is.
    newest = latest_per_key(keyed(df), (KEY.name,), ties=ORDER[1:]).repartition(buckets, KEY.name)
    bucket = F.pmod(F.hash(KEY.name), F.lit(buckets))
    # One number for each bucket at most.
    touched = sorted(r[0] for r in changed(table, newest).select(bucket).distinct().collect())
    if touched:
        part = table.where(F.col(BUCKET.name).isin(touched))
        whole = merged(part, changed(part, newest.where(bucket.isin(touched))))
        with tables.dynamic_overwrite(spark):
            whole.select(*SILVER.names, KEY.name, bucket.alias(BUCKET.name)).write.insertInto(name, overwrite=True)
    return touched


def scan(spark: SparkSession, name: str) -> DataFrame:
    """The newest row of each listing."""
    return spark.table(name).drop(KEY.name, BUCKET.name)
