"""Closed days in few files, while others read."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from parcelle.jobs import build_silver, close_raw_days, create_tables
from parcelle.operators.payloads import kafka_records
from parcelle.queries import inputs
from parcelle.sources import compaction, tables
from parcelle.streaming import raw_sink

DAYS = [dt.date(2025, 11, d) for d in (1, 2, 3)]


@pytest.fixture
def raw(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = spark.range(3000).selectExpr(
        "cast(id as string) as id", "concat('{\"v\":', id, '}') as payload", "timestamp'2025-11-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id * 86) as ingest_ts")
    tables.with_partition(rows).repartition(30).write.partitionBy("ingest_date").parquet(path)
    return path


def rows_of(df):
    return sorted(tuple(r) for r in df.select("id", "payload", "ingest_ts").collect())


def test_same_rows_in_few_files(spark, raw):
    before = rows_of(tables.scan_files(spark, raw))
    planned = compaction.scan_raw(spark, raw)
    assert rows_of(planned) == before
    assert compaction.close_days(spark, raw, DAYS[2], rows_of_a_file=600) == DAYS[:2]
    after = compaction.scan_raw(spark, raw)
    assert rows_of(after) == before == rows_of(planned)  # who planned before the swap goes on with what there was
    read = {r[0] for r in after.select(F.input_file_name()).distinct().collect()}
    assert sum("_closed/" in f for f in read) == 4 and not any(f"ingest_date={d}" in f for f in read for d in DAYS[:2])
    assert len({f for f in tables.scan_files(spark, raw).inputFiles()}) >= 60
    assert compaction.close_days(spark, raw, DAYS[2]) == []
    assert compaction.close_days(spark, raw, dt.date(2030, 1, 1)) == [DAYS[2]]
    assert rows_of(compaction.scan_raw(spark, raw)) == before


def test_a_rewrite_that_fails_changes_nothing(spark, raw, monkeypatch):
    before = rows_of(tables.scan_files(spark, raw))
    real = compaction.F.current_timestamp
    monkeypatch.setattr(compaction.F, "current_timestamp", lambda: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        compaction.close_days(spark, raw, DAYS[1])
    monkeypatch.setattr(compaction.F, "current_timestamp", real)
    assert glob.glob(f"{raw}_closed/days/*") and compaction.closed_days(spark, raw) == {}
    assert rows_of(compaction.scan_raw(spark, raw)) == before
    assert compaction.close_days(spark, raw, DAYS[1]) == DAYS[:1]
    assert rows_of(compaction.scan_raw(spark, raw)) == before


def test_a_fresh_window_skips_files_of_closed_days(spark, raw):
    compaction.close_days(spark, raw, DAYS[2], rows_of_a_file=300)
    as_of = dt.datetime(2025, 11, 2, 13, 0)
    fresh = compaction.scan_raw(spark, raw, 60, as_of)
    want = tables.scan_files(spark, raw, minutes=60, as_of=as_of)
    assert rows_of(fresh) == rows_of(want) and fresh.count()
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(ingest_ts") == 2 and "Exchange" not in plan


def test_a_stream_goes_on_beside_it(spark, tmp_path, sf_dir):
    source, target, checkpoint = (str(tmp_path / d) for d in ("in", "raw", "cp"))
    for part in range(2):
        kafka_records(inputs.listing_a(spark, sf_dir).drop("ingest_ts").limit(40)).coalesce(1).write.mode("append").parquet(source)
        raw_sink.start_raw_sink(raw_sink.file_records(spark, source), target, checkpoint, tables.PARQUET, once=True).awaitTermination()
        if part == 0:
            tomorrow = dt.datetime.now(dt.timezone.utc).date() + dt.timedelta(days=1)
            days = close_raw_days.main(["--raw-files", target, "--before", str(tomorrow)])
            assert len(days) == 1 and compaction.scan_raw(spark, target).count() == 40
    # The day was closed too early on purpose: what came later is not in its files, and closing again is for the next day on.
    assert tables.scan_files(spark, target).count() == 80 and compaction.scan_raw(spark, target).count() == 40


def test_the_job_reads_closed_days(spark, raw):
    compaction.close_days(spark, raw, DAYS[2])
    create_tables.main(["--provider", "parquet", "--silver"])
    build_silver.main(["--provider", "parquet", "--source", "avito", "--raw-files", raw, "--window-mins", "0"])
    tables.drop_table(spark, "silver.listings_all")
