"""The stream from record files to the raw folder, and the jobs around it."""

import json

import pytest
from pyspark.sql import functions as F

from parcelle.jobs import build_silver, create_tables, read_pages, stream_raw
from parcelle.operators.payloads import kafka_records
from parcelle.queries import inputs
from parcelle.sources import tables
from parcelle.streaming import raw_sink


def records(spark, first, count):
    return kafka_records(spark.range(first, first + count).select(
        F.col("id").cast("string").alias("id"),
        F.concat(F.lit("https://e.test/x_"), "id", F.lit(".htm")).alias("url"),
    ))


def run(spark, source, target, checkpoint):
    query = raw_sink.start_raw_sink(
        raw_sink.file_records(spark, source, files_per_batch=1), target, checkpoint, tables.PARQUET, once=True
    )
    query.awaitTermination()
    return query


def test_restart_takes_up_where_it_ended(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / d) for d in ("in", "raw", "cp"))
    records(spark, 0, 100).repartition(3).write.parquet(source)
    first = run(spark, source, target, checkpoint)
    raw = tables.scan_files(spark, target)
    assert raw.count() == 100
    assert len([p for p in first.recentProgress if p.numInputRows]) == 3
    # One arrival time per micro-batch: versions within a batch are told apart by payload.
    assert raw.select("ingest_ts").distinct().count() == 3
    run(spark, source, target, checkpoint)
    assert tables.scan_files(spark, target).count() == 100
    records(spark, 100, 20).coalesce(1).write.mode("append").parquet(source)
    run(spark, source, target, checkpoint)
    after = tables.scan_files(spark, target)
    assert after.count() == 120 and after.select("id").distinct().count() == 120
    assert json.loads(after.first().payload)["id"] == after.first().id


def test_stream_does_not_shuffle(spark, tmp_path):
    source = str(tmp_path / "in")
    records(spark, 0, 10).write.parquet(source)
    query = run(spark, source, str(tmp_path / "raw"), str(tmp_path / "cp"))
    plan = query._jsq.explainInternal(False)
    assert "Project" in plan and "Exchange" not in plan


@pytest.mark.parametrize("given, expected", [
    ("", "15 seconds"), (None, "15 seconds"), ("10", "10 seconds"), (10, "10 seconds"), ("10s", "10 seconds"),
    ("10 s", "10 seconds"), ("10 sec", "10 seconds"), ("10secs", "10 seconds"), (" 10 Seconds ", "10 seconds"),
    ("PT10S", "10 seconds"), ("PT1M10S", "70 seconds"), ("PT1H", "3600 seconds"), ("5 minutes", "300 seconds"),
    ("500 milliseconds", "500 milliseconds"), ("1 day", "1 day"), ("pt", "pt"),
])
def test_trigger_interval(given, expected):
    assert raw_sink.trigger_interval(given) == expected


def test_checkpoint_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert raw_sink.checkpoint_for(spark, "x") == f"{shared}/streams/x_raw"


def test_unknown_provider(spark, tmp_path):
    with pytest.raises(ValueError):
        raw_sink.start_raw_sink(spark.readStream.format("rate").load().selectExpr(
            "cast(null as binary) key", "cast(null as binary) value"), "t", str(tmp_path), "delta")


def test_preview_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    records(spark, 0, 2).coalesce(1).write.parquet(source)
    query = raw_sink.start_preview(raw_sink.file_records(spark, source), "1")
    query.processAllAvailable()
    query.stop()
    assert sum(p.numInputRows for p in query.recentProgress) == 2


def test_stream_without_target_feeds_the_next_job(spark, sf_dir, tmp_path):
    source = str(tmp_path / "records")
    kafka_records(inputs.listing_a(spark, sf_dir).drop("ingest_ts").limit(200)).write.parquet(source)
    parquet = ["--provider", "parquet"]
    create_tables.main([*parquet, "--silver"])
    stream_raw.main([*parquet, "--source", "avito", "--records", source, "--checkpoint", str(tmp_path / "cp"), "--once"])
    assert tables.scan(spark, "raw.avito").count() == 200
    build_silver.main([*parquet, "--source", "avito", "--mode", "merge"])
    assert tables.scan(spark, "silver.listings_all").count() > 0
    for name in ("raw.avito", "silver.listings_all"):
        tables.drop_table(spark, name)


def test_links_job(spark, tmp_path):
    pages = [(1, '<div><a href="/fr/a_1.htm">x</a></div>'), (2, None)]
    spark.createDataFrame(pages, "page_id long, html string").selectExpr("page_id", "'u' url", "html").write.parquet(str(tmp_path / "pages"))
    read_pages.main(["--source", "avito", "--what", "links", "--limit", "5", "--pages", str(tmp_path / "pages"), "--out", str(tmp_path / "csv")])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns in (["page_id", "pos", "link"], [])


def test_jobs_end_to_end(spark, sf_dir, tmp_path):
    source, raw = str(tmp_path / "records"), str(tmp_path / "raw")
    listings = inputs.listing_a(spark, sf_dir).drop("ingest_ts")
    kafka_records(listings).write.parquet(source)
    parquet = ["--provider", "parquet"]
    assert create_tables.main([*parquet, "--sources", "avito", "--silver"]) == ["raw.avito", "silver.listings_all"]
    stream_raw.main([*parquet, "--records", source, "--target", raw, "--checkpoint", str(tmp_path / "cp"), "--once"])
    assert tables.scan_files(spark, raw).count() == listings.count()
    build_silver.main([*parquet, "--source", "avito", "--raw-files", raw])
    silver = tables.scan(spark, "silver.listings_all")
    once = silver.count()
    assert 0 < once < listings.count()
    build_silver.main([*parquet, "--source", "avito", "--raw-files", raw, "--mode", "merge", "--rebalance"])
    assert tables.scan(spark, "silver.listings_all").count() == once
    with pytest.raises(SystemExit):
        build_silver.main([*parquet, "--source", "avito", "--mode", "overwrite"])
    tables.drop_table(spark, "silver.listings_all")

    read_pages.main([
        "--source", "mubawab", "--pages", f"{sf_dir}/pages.parquet", "--sink", "csv", "--out", str(tmp_path / "csv"),
    ])
    written = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert written.count() == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
