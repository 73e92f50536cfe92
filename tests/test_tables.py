"""Tables and files on a temporary warehouse."""

import csv
import datetime as dt
import glob

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from parcelle.plans.silver import silver_a
from parcelle.queries import inputs
from parcelle.schemas import RAW, SILVER
from parcelle.sources import files, kafka, tables


@pytest.fixture
def silver_table(spark):
    name = tables.create_silver_table(spark, provider=tables.PARQUET)
    yield name
    tables.drop_table(spark, name)


def rows(spark, *days, site="s"):
    data = [(f"id{i}", dt.datetime(2025, 11, d, 23, 30), site) for i, d in enumerate(days)]
    short = spark.createDataFrame(data, "id string, ingest_ts timestamp, site string")
    return short.select(*(
        F.col(f.name) if f.name in short.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in SILVER
    ))


def test_raw_tables(spark, caplog):
    created = tables.create_raw_tables(spark, [" AVITO ", "other", "mubawab"], provider=tables.PARQUET)
    assert created == ["raw.avito", "raw.mubawab"]
    assert "other" in caplog.text
    assert created == tables.create_raw_tables(spark, ["avito", "mubawab"], provider=tables.PARQUET)
    assert {r.tableName for r in tables.tables(spark, "raw").collect()} == {"avito", "mubawab"}
    assert "raw" in {r.namespace for r in tables.namespaces(spark).collect()}
    assert [r.col_name for r in tables.describe(spark, created[0]).collect()][:3] == RAW.names
    assert tables.properties(spark, created[0]).columns == ["key", "value"]
    tables.drop_table(spark, created[0])
    assert not spark.catalog.tableExists(created[0])


def test_iceberg_ddl_parses(spark):
    parser = spark._jsparkSession.sessionState().sqlParser()
    for schema in (RAW, SILVER):
        ddl = tables.table_ddl("lake.ns.t", schema)
        assert "days(ingest_ts)" in ddl and parser.parsePlan(ddl) is not None
    assert "site STRING NOT NULL" in tables.table_ddl("t", SILVER)


def test_append_and_overwrite_days(spark, silver_table):
    write = lambda df, mode: tables.write_silver(df, silver_table, mode, tables.PARQUET)
    days = lambda: sorted(r.ingest_ts.day for r in tables.scan(spark, silver_table).collect())
    write(rows(spark, 1, 2, 2), "append")
    write(rows(spark, 3), None)
    assert days() == [1, 2, 2, 3]
    write(rows(spark, 2), "overwrite")
    assert days() == [1, 2, 3]
    write(rows(spark, 3, 3), "Dynamic-Overwrite")
    assert days() == [1, 2, 3, 3]
    with pytest.raises(ValueError):
        write(rows(spark, 1), "upsert")
    assert tables.scan(spark, silver_table).columns == SILVER.names


def test_merge_adds_what_is_new(spark, silver_table):
    for mode in ("merge", "MERGE"):
        tables.write_silver(rows(spark, 1, 2, 3), silver_table, mode, tables.PARQUET)
        assert tables.scan(spark, silver_table).count() == 3
    tables.write_silver(rows(spark, 1, 2, 4), silver_table, "merge", tables.PARQUET)
    assert tables.scan(spark, silver_table).count() == 4
    tables.write_silver(rows(spark, 1, site="other"), silver_table, "merge", tables.PARQUET)
    assert tables.scan(spark, silver_table).count() == 5


def test_overwriting_one_site_keeps_the_other(spark, silver_table):
    write = lambda df, mode: tables.write_silver(df, silver_table, mode, tables.PARQUET)
    write(rows(spark, 1, 2), "append")
    write(rows(spark, 1, 1, 2, site="other"), "append")
    write(rows(spark, 1, site="other"), "overwrite")
    found = sorted((r.site, r.ingest_ts.day) for r in tables.scan(spark, silver_table).collect())
    assert found == [("other", 1), ("other", 2), ("s", 1), ("s", 2)]


def test_typed_view(spark, silver_table):
    dated = rows(spark, 1, 2, 3).withColumn("published_date", F.when(F.col("id") == "id0", "2025-10-31 10:00:00").when(F.col("id") == "id1", "soon"))
    tables.write_silver(dated, silver_table, provider=tables.PARQUET)
    tables.create_typed_view(spark, silver_table, "silver.listings_typed")
    got = {r.id: r.published_at for r in spark.table("silver.listings_typed").collect()}
    assert got == {"id0": dt.datetime(2025, 10, 31, 10, 0), "id1": None, "id2": None}
    spark.sql("DROP VIEW silver.listings_typed")


def test_site_must_be_there(spark, silver_table):
    with pytest.raises(PySparkException):
        tables.write_silver(rows(spark, 1, site=None), silver_table, provider=tables.PARQUET)


def test_columns_are_written_by_name(spark, silver_table):
    shuffled = rows(spark, 1).select(*reversed(SILVER.names))
    tables.write_silver(shuffled, silver_table, provider=tables.PARQUET)
    assert tables.scan(spark, silver_table).first().site == "s"


def test_rebalanced_write_keeps_all_rows(spark, silver_table):
    many = rows(spark, *([1] * 50 + [2] * 5)).repartition(8)
    tables.write_silver(many, silver_table, provider=tables.PARQUET, rebalance=True)
    assert tables.scan(spark, silver_table).count() == 55
    assert len(spark.table(silver_table).inputFiles()) <= 3


def test_fresh_scan_prunes_days_and_pushes_the_time(spark, silver_table):
    tables.write_silver(rows(spark, 1, 2, 3), silver_table, provider=tables.PARQUET)
    fresh = tables.scan(spark, silver_table, 60, dt.datetime(2025, 11, 3, 0, 10))
    assert sorted(r.ingest_ts.day for r in fresh.collect()) == [2, 3]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "(ingest_date" in plan
    assert "GreaterThanOrEqual(ingest_ts" in plan
    assert len(tables.scan(spark, silver_table, 60, dt.datetime(2025, 11, 3, 12, 0)).collect()) == 1


def test_silver_from_table_to_table(spark, sf_dir, silver_table, tmp_path):
    raw = tables.with_partition(inputs.raw_a(spark, sf_dir))
    path = str(tmp_path / "raw")
    raw.limit(500).write.partitionBy("ingest_date").parquet(path)
    listings = silver_a(tables.scan_files(spark, path))
    tables.write_silver(listings, silver_table, provider=tables.PARQUET)
    assert tables.scan(spark, silver_table).exceptAll(listings).isEmpty()


def test_csv_is_quoted_and_squeezed(spark, tmp_path):
    df = spark.createDataFrame([(' a\n b "q" ', None, 1.5), ("", "é,;", None)], "t string, u string, n double")
    for squeeze, first in ((False, ' a\n b "q" '), (True, 'a b "q"')):
        path = str(tmp_path / str(squeeze))
        files.write_csv(df.coalesce(1), path, squeeze)
        (part,) = glob.glob(path + "/*.csv")
        with open(part, newline="", encoding="utf-8") as f:
            assert list(csv.reader(f)) == [["t", "u", "n"], [first, "", "1.5"], ["", "é,;", ""]]
        with open(part, newline="", encoding="utf-8") as f:
            assert f.readline() == '"t","u","n"\n'


def test_kafka_options():
    assert kafka.source_options("b:1", "t", "earliest") == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "earliest",
    }
    with pytest.raises(ValueError):
        kafka.source_options("b:1", "t", "yesterday")
    sink = kafka.sink_options("b:1", "t")
    assert (sink["topic"], sink["kafka.acks"], sink["kafka.enable.idempotence"]) == ("t", "all", "true")
    assert (sink["kafka.compression.type"], sink["kafka.linger.ms"]) == ("lz4", "20")
