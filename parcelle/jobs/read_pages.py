"""Turn a table of pages into listing links, or into records for a topic or CSV files."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from parcelle import fixed_values as V
from parcelle.jobs import common
from parcelle.operators.pages import first_links
from parcelle.plans import page_records
from parcelle.sources import files, kafka, seen_links
from parcelle.streaming import page_stream, raw_sink


def write_links(pages: DataFrame, given: argparse.Namespace) -> None:
    """Listing links of result pages, each where it is met first, as CSV files."""
    usual = None if given.source == V.SITE_A else V.LINKS_PER_PAGE_M
    per_page = (usual if given.per_page is None else given.per_page) or None
    links_of = page_records.listing_links_a if given.source == V.SITE_A else page_records.listing_links_m
    links = links_of(pages, per_page)
    if not given.new:
        files.write_csv(first_links(links, given.limit).select("page_id", "pos", "link"), given.out)
        return
    # Only links that no earlier run gave; a run that fails before it has noted them gives them again.
    name = seen_links.create_seen_table(pages.sparkSession, given.source, given.catalog)
    fresh = seen_links.unseen(first_links(links), name).orderBy("page_id", "pos")
    fresh = (fresh if given.limit is None else fresh.limit(given.limit)).persist(StorageLevel.MEMORY_AND_DISK)
    files.write_csv(fresh.select("page_id", "pos", "link"), given.out)
    seen_links.record(fresh, name)
    fresh.unpersist()


def stream_records(spark: SparkSession, given: argparse.Namespace) -> None:
    """Records of pages as these arrive, to the topic or below a folder; unreadable pages to a folder beside it."""
    if given.sink == "csv":
        deliver = page_stream.to_folder(f"{given.out}/records")
    else:
        topic = given.topic or V.TOPICS[given.source]
        deliver = lambda rows, _: kafka.write_records(rows, given.bootstrap, topic)
    page_stream.start_page_stream(
        page_stream.file_pages(spark, given.pages), given.source, given.mode, deliver, page_stream.to_folder(f"{given.out}/errors"),
        given.checkpoint or raw_sink.checkpoint_for(spark, given.source, "pages"), given.trigger, given.once,
    ).awaitTermination()


def main(argv: Sequence[str] | None = None) -> None:
    args = common.parser(__doc__)
    args.add_argument("--source", choices=V.SITES, required=True)
    args.add_argument("--pages", required=True, help="Parquet folder of (page_id, url, html)")
    args.add_argument("--mode", choices=("louer", "vendre", "acheter"), default="louer")
    args.add_argument("--what", choices=("records", "links", "stream"), default="records")
    args.add_argument("--limit", type=int, help="links in all, in crawl order")
    args.add_argument("--new", action="store_true", help="only links that no earlier run gave")
    args.add_argument("--per-page", type=int, help="links of a page, 0 for all; 25 for source M if not given, as its crawler has it")
    args.add_argument("--sink", choices=("kafka", "csv"), default="kafka")
    args.add_argument("--out", help="folder for CSV files, and for what a stream writes")
    args.add_argument("--bootstrap", default="kafka:9092")
    args.add_argument("--topic", help="the source's own if not given")
    args.add_argument("--trigger", default=V.TRIGGER, help="of a stream")
    args.add_argument("--checkpoint", help="of a stream; else its own below the shared folder")
    args.add_argument("--once", action="store_true", help="a stream takes what is there and ends")
    given = args.parse_args(argv)
    spark = common.session(given, f"{given.source}-read-pages")
    if given.what == "stream":
        stream_records(spark, given)
        return
    pages = spark.read.parquet(given.pages)
    if given.what == "links":
        write_links(pages, given)
        return
    records = page_stream.records_of(pages, given.source, given.mode).drop("page_id")
    if given.sink == "csv":
        files.write_csv(records, given.out, squeeze=given.source == V.SITE_M)
    else:
        kafka.write_records(records, given.bootstrap, given.topic or V.TOPICS[given.source])


if __name__ == "__main__":
    main()
