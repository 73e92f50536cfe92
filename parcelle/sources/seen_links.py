"""Links met in earlier runs, so that a run gives only what is new.

The table is bucketed by link, so a comparison shuffles the run's links alone. Before that a filter
over all known links, sized by their number, lets through without a comparison what is surely
new; only links that may be known are compared, exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle import fixed_values as V
from parcelle.sources import tables

BUCKETS = 64
#: Bits of the filter for each known link, and at most (32 MB); beyond that all links are compared.
BITS_OF_A_LINK, MOST_BITS = 16, 1 << 28
#: What one bitmap of Spark's holds.
_BITMAP = 32768


def create_seen_table(spark: SparkSession, site: str, catalog: str | None = None, buckets: int = BUCKETS) -> str:
    name = tables.table_name(tables.create_namespace(spark, V.RAW_NAMESPACE, catalog), f"{site}_seen_links")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (link STRING, page_id BIGINT, seen_at TIMESTAMP) USING parquet "
        f"CLUSTERED BY (link) INTO {buckets} BUCKETS")
    return name


def filter_bits(count: int) -> int:
    """A power of two for so many links; 0 where none is large enough."""
    bits = 1 << max(16, (BITS_OF_A_LINK * count - 1).bit_length())
    return bits if bits <= MOST_BITS else 0


def _place(link: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(link), F.lit(bits))


def filter_of(seen: DataFrame, bits: int) -> DataFrame:
    """(bucket, map): the filter as bitmaps, a row for each 4 kB that has a bit."""
    placed = seen.select(_place(F.col("link"), bits).alias("at"))
    return placed.groupBy(F.floor(F.col("at") / _BITMAP).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("at") % _BITMAP).alias("map"))


def may_be_in(links: DataFrame, bitmaps: DataFrame, bits: int) -> DataFrame:
    """Links with ``maybe``: whether the filter knows them."""
    at = _place(F.col("link"), bits)
    placed = links.withColumns({"_bucket": F.floor(at / _BITMAP), "_bit": (at % _BITMAP).cast("int")})
    joined = placed.join(F.broadcast(bitmaps.withColumnRenamed("bucket", "_bucket")), "_bucket", "left")
    byte = F.expr("cast(conv(hex(substring(map, _bit div 8 + 1, 1)), 16, 10) as int)")
    known = F.call_function("getbit", byte, F.col("_bit") % 8) == 1
    return joined.withColumn("maybe", F.coalesce(known, F.lit(False))).select(*links.columns, "maybe")


def unseen(links: DataFrame, name: str) -> DataFrame:
    """The rows of links that are not in the table. ``links`` has each link once."""
    spark = links.sparkSession
    seen = spark.table(name).select("link")
    bits = filter_bits(spark.table(name).count())
    if not bits:
        return links.join(seen, "link", "left_anti").select(*links.columns)
    flagged = may_be_in(links, filter_of(seen, bits), bits)
    compared = flagged.where("maybe").join(seen, "link", "left_anti")
    return flagged.where("NOT maybe").unionByName(compared).select(*links.columns)


def record(links: DataFrame, name: str) -> None:
    """Adds new links to the table."""
    links.select("link", F.col("page_id").cast("long").alias("page_id"), F.current_timestamp().alias("seen_at")).write.insertInto(name)
