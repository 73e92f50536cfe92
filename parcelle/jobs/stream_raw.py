"""Append one topic to the raw table of its source, until stopped."""

from __future__ import annotations

from collections.abc import Sequence

from parcelle import fixed_values as V
from parcelle.jobs import common
from parcelle.sources import kafka, tables
from parcelle.streaming import raw_sink


def main(argv: Sequence[str] | None = None) -> None:
    args = common.parser(__doc__)
    args.add_argument("--source", choices=V.SITES, default=V.SITE_A)
    args.add_argument("--bootstrap", default="kafka:9092")
    args.add_argument("--topic", help="the source's own if not given")
    args.add_argument("--records", help="folder of record files to read instead of a topic")
    args.add_argument("--target", help="table, or for parquet a path; the source's own table if not given")
    args.add_argument("--checkpoint", help="below spark.checkpoint.dir if not given")
    args.add_argument("--starting-offsets", choices=(kafka.EARLIEST, kafka.LATEST), default=kafka.LATEST)
    args.add_argument("--trigger", default=V.TRIGGER)
    args.add_argument("--records-per-trigger", type=int, help="upper bound of a micro-batch")
    args.add_argument("--once", action="store_true", help="take what is there and end")
    given = args.parse_args(argv)
    spark = common.session(given, f"{given.source}-stream-raw")
    if given.records:
        records = raw_sink.file_records(spark, given.records)
    else:
        topic = given.topic or V.TOPICS[given.source]
        records = kafka.record_stream(
            spark, given.bootstrap, topic, given.starting_offsets, given.records_per_trigger
        )
    if not given.target:
        tables.create_raw_tables(spark, [given.source], given.catalog, given.provider)
    raw_sink.start_raw_sink(
        records,
        given.target or common.raw_table(given, given.source),
        given.checkpoint or raw_sink.checkpoint_for(spark, given.source),
        given.provider,
        given.trigger,
        given.once,
    ).awaitTermination()


if __name__ == "__main__":
    main()
