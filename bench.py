"""Seconds per named query over the tables in $BENCH_SF_DIR, as one JSON line.

Each query runs to completion into a sink that discards rows, once to warm up and
then $BENCH_RUNS times, of which the fastest counts. The files of the stream are put
below $BENCH_DIR, or the machine's temporary folder; the bench runs on one machine.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from parcelle.operators.payloads import kafka_records
from parcelle.queries import QUERIES, inputs
from parcelle.session import build_session
from parcelle.sources.tables import PARQUET
from parcelle.streaming.raw_sink import file_records, start_raw_sink


def seconds(spark, query, sf_dir: str, runs: int) -> float:
    taken = []
    for _ in range(1 + runs):
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - start)
    return round(min(taken[1:]), 3)


def stream_rate(spark, sf_dir: str) -> int:
    """Rows per second from record files to the raw folder."""
    with tempfile.TemporaryDirectory(prefix="run-", dir=os.environ.get("BENCH_DIR")) as folder:
        events = inputs.table(spark, sf_dir, "events").selectExpr(
            "cast(event_id as string) id", "event_type", "props"
        )
        kafka_records(events).repartition(8).write.parquet(f"{folder}/in")
        rows = events.count()
        start = time.perf_counter()
        start_raw_sink(
            file_records(spark, f"{folder}/in"), f"{folder}/raw", f"{folder}/checkpoint", PARQUET, once=True
        ).awaitTermination()
        return round(rows / (time.perf_counter() - start))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    spark = build_session("bench", f"local[{cpus}]", {"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(QUERIES)
    timed = {name: seconds(spark, QUERIES[name], sf_dir, runs) for name in names}
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "stream_rows_per_sec": stream_rate(spark, sf_dir),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
