"""Pages as a stream, and counts made on the way of the rows."""

import json

import pytest
from pyspark.sql import functions as F

from parcelle.jobs import build_silver, create_tables, read_pages
from parcelle.operators import profiling
from parcelle.operators.audits import Audit
from parcelle.operators.payloads import parse_payload
from parcelle.plans.silver import silver_a
from parcelle.queries import inputs
from parcelle.schemas import PAYLOAD_A
from parcelle.sources import latest, tables
from parcelle.streaming import page_stream


def write_pages(spark, sf_dir, path, files=4):
    pages = inputs.listing_pages(spark, sf_dir, "a").where("page_id < 400")
    pages.select(F.col("page_id").cast("long"), "url", "html").coalesce(1).repartition(files, "page_id").write.mode("append").parquet(path)
    return pages.count()


def run(spark, path, out, checkpoint, records=None, errors=None):
    query = page_stream.start_page_stream(
        page_stream.file_pages(spark, path, files_per_batch=1), "avito", "vendre", records or page_stream.to_folder(f"{out}/records"),
        errors or page_stream.to_folder(f"{out}/errors"), checkpoint, once=True)
    query.awaitTermination()


@pytest.mark.parametrize("fails_in", ["records", "errors"])
def test_restart_loses_no_page_and_reads_none_twice(spark, sf_dir, tmp_path, fails_in):
    path, out, checkpoint = (str(tmp_path / d) for d in ("pages", "out", "cp"))
    count = write_pages(spark, sf_dir, path)
    write = page_stream.to_folder(f"{out}/{fails_in}")

    def failing(rows, batch):
        write(rows, batch)  # the batch fails after it has written
        if batch == 2:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run(spark, path, out, checkpoint, **{fails_in: failing})
    run(spark, path, out, checkpoint)
    run(spark, path, out, checkpoint)
    read, bad = (spark.read.parquet(f"{out}/{kind}") for kind in ("records", "errors"))
    addresses = [r.url for df in (read, bad) for r in df.select("url").collect()]
    assert len(addresses) == len(set(addresses)) == count
    assert bad.count() > 0 and {r.error for r in bad.collect()} <= {"page has no text", "date value out of range"}
    assert read.where("title IS NULL").isEmpty()
    # More pages: only these are read.
    write_pages(spark, sf_dir, path, files=1)
    run(spark, path, out, checkpoint)
    assert spark.read.parquet(f"{out}/records").count() == 2 * read.count()


def test_stream_job(spark, sf_dir, tmp_path):
    count = write_pages(spark, sf_dir, str(tmp_path / "pages"), 2)
    read_pages.main([
        "--what", "stream", "--source", "mubawab", "--pages", str(tmp_path / "pages"), "--sink", "csv", "--out", str(tmp_path / "out"),
        "--checkpoint", str(tmp_path / "cp"), "--once"])
    rows = [spark.read.parquet(str(tmp_path / "out" / kind)).count() for kind in ("records", "errors")]
    assert sum(rows) == count and rows[1] > 0


def test_audit_counts_what_the_queries_count(spark, sf_dir):
    raw = inputs.raw_of(inputs.listing_a(spark, sf_dir), "if(id like '%7', 'other', id)").withColumn(
        "payload", F.when(F.unix_seconds("ingest_ts") % 13 == 0, "no object").otherwise(F.col("payload")))
    audit = Audit()
    silver = audit.of_written(silver_a(raw, audit=audit))
    assert silver._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2  # of the fixture's union, as without an audit
    rows = silver.collect()
    want = profiling.malformed_rows(raw).first()
    parsed = parse_payload(raw, PAYLOAD_A, ["id"], keep=["record_id"])
    assert audit.report()["read"] == {"rows": want.rows, "malformed": want.malformed, "id_mismatch": profiling.id_mismatch(parsed).count()}
    assert want.malformed and audit.report()["read"]["id_mismatch"]
    assert audit.report()["written"] == {
        "rows": len(rows), "null_price": sum(r.price is None for r in rows), "offer_mismatch": sum(r.offre_match is False for r in rows)}


def test_build_silver_reports_and_keeps_the_newest(spark, sf_dir, tmp_path, capsys):
    raw = str(tmp_path / "raw")
    tables.with_partition(inputs.raw_a(spark, sf_dir)).write.partitionBy("ingest_date").parquet(raw)
    create_tables.main(["--provider", "parquet", "--silver"])
    build = ["--provider", "parquet", "--source", "avito", "--raw-files", raw, "--window-mins", "0", "--latest"]
    for mode in ("append", "merge"):
        build_silver.main([*build, "--mode", mode])
    first, again = (json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{"))
    assert first["read"] == again["read"] and first["read"]["rows"] == inputs.raw_a(spark, sf_dir).count()
    assert first["written"]["rows"] > 0 and again["written"]["rows"] == 0
    kept = latest.scan(spark, "silver.listings_latest")
    assert kept.count() == tables.scan(spark, "silver.listings_all").select("site", "id").distinct().count()
    for name in ("silver.listings_all", "silver.listings_latest"):
        tables.drop_table(spark, name)
