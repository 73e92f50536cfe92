"""Labels of the data as columns of the unified table.

Which labels there are is kept in a table: for each site the label, the column name it stands for
and the day it was met first. A run looks at its own rows alone, writes down the labels that
are not known, and adds their columns to the unified table; days written before are not read again
and have NULLs there. Names of the unified table's own columns are never taken, and of labels
with one name the smallest in an object counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle import fixed_values as V
from parcelle.functions.bags import attribute_map
from parcelle.functions.dates import utc_day
from parcelle.functions.text import column_name
from parcelle.schemas import PARTITION, PAYLOAD_A, PAYLOAD_M, SILVER, only
from parcelle.sources import tables

#: Where each site has its attributes.
_FIELDS = {V.SITE_A: (PAYLOAD_A, "attributes"), V.SITE_M: (PAYLOAD_M, "features_main_json")}
_COLUMNS = "site STRING, label STRING, name STRING, first_day DATE"


def create_label_table(spark: SparkSession, catalog: str | None = None, provider: str = tables.ICEBERG) -> str:
    name = tables.table_name(tables.create_namespace(spark, V.SILVER_NAMESPACE, catalog), V.LABEL_TABLE)
    using = {tables.ICEBERG: "iceberg", tables.PARQUET: "parquet"}[provider]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_COLUMNS}) USING {using}")
    return name


def labels_of(raw: DataFrame, schema, field: str) -> DataFrame:
    """(label, first_day) of the labels in one attribute field of envelopes, each once."""
    bag: Column = attribute_map(F.from_json("payload", only(schema, field))[field])
    rows = raw.select(F.explode(F.map_keys(bag)).alias("label"), utc_day(F.col("ingest_ts")).alias("day"))
    return rows.groupBy("label").agg(F.min("day").alias("first_day"))


def register(raw: DataFrame, site: str, name: str) -> int:
    """Writes down the labels of the rows that the table does not have, and gives their number."""
    schema, field = _FIELDS[site]
    known = raw.sparkSession.table(name).where(F.col("site") == site).select("label")
    fresh = labels_of(raw, schema, field).join(known, "label", "left_anti").select(
        F.lit(site).alias("site"), "label", column_name(F.col("label")).alias("name"), "first_day")
    before = raw.sparkSession.table(name).count()
    fresh.where("name != ''").write.insertInto(name)
    return raw.sparkSession.table(name).count() - before


def names_of(spark: SparkSession, name: str, site: str) -> list[str]:
    """Columns of a site's labels beside the unified table's own, in order. They come to the driver as the columns of a table do."""
    rows = spark.table(name).where(F.col("site") == site).select("name").distinct()
    return sorted(r[0] for r in rows.where(~F.col("name").isin(*SILVER.names, PARTITION.name)).collect())


def add_columns(spark: SparkSession, table: str, names: list[str]) -> list[str]:
    """Adds the text columns that the table does not have, and gives them."""
    there = set(spark.table(table).columns)
    missing = [n for n in names if n not in there]
    if missing:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{n}` STRING' for n in missing)})")
    return missing


def follow(raw: DataFrame, site: str, label_table: str, silver_table: str) -> list[str]:
    """Brings the label table and the unified table's columns up to date with the rows; the site's columns from labels."""
    register(raw, site, label_table)
    names = names_of(raw.sparkSession, label_table, site)
    add_columns(raw.sparkSession, silver_table, names)
    return names
