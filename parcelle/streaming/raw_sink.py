"""Records to raw envelopes, micro-batch by micro-batch.

The stream keeps no state and does not shuffle: each task decodes its records and
writes them. Versions of a listing are told apart later, in batch. One query per
source, told apart by topic, target and checkpoint.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from parcelle import fixed_values as V
from parcelle.operators.payloads import decode_records, preview_lines, raw_envelope
from parcelle.schemas import PARTITION, RECORD
from parcelle.sources.tables import ICEBERG, PARQUET, with_partition

_SECONDS = {"": 1, "s": 1, "sec": 1, "second": 1, "m": 60, "min": 60, "minute": 60, "h": 3600, "hour": 3600}
_PLAIN = re.compile(r"(\d+)\s*([a-z]*?)s?")
_ISO = re.compile(r"pt(?:(\d+)h)?(?:(\d+)m)?(?:(\d+)s)?")


def trigger_interval(text: str | int | None) -> str:
    """'10', '10s', '10 secs', 'PT1M10S' as an interval in seconds; anything else as it is."""
    given = str(text or "").strip().lower()
    if not given:
        return V.TRIGGER
    plain = _PLAIN.fullmatch(given)
    # A lone 's' is the unit, not the plural of nothing.
    if plain and plain[2] in _SECONDS:
        return f"{int(plain[1]) * _SECONDS[plain[2]]} seconds"
    iso = _ISO.fullmatch(given)
    if iso and any(iso.groups()):
        hours, minutes, seconds = (int(part or 0) for part in iso.groups())
        return f"{hours * 3600 + minutes * 60 + seconds} seconds"
    return given


def checkpoint_for(spark: SparkSession, source: str, kind: str = "raw") -> str:
    """A stream's checkpoint below the folder the cluster shares for checkpoints."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("give a checkpoint location, or set spark.checkpoint.dir")
    return f"{shared.rstrip('/')}/streams/{source}_{kind}"


def file_records(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """(key, value) records out of a folder of Parquet files, as new files arrive."""
    reader = spark.readStream.schema(RECORD)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def start_raw_sink(
    records: DataFrame,
    target: str,
    checkpoint: str,
    provider: str = ICEBERG,
    trigger: str | None = V.TRIGGER,
    once: bool = False,
) -> StreamingQuery:
    """Append records to a raw table, or with ``parquet`` to a day-partitioned folder if the
    target is a path (it has a ``/``).

    With ``once`` it takes what is there and ends; otherwise it goes on at every
    trigger. A restart on the same checkpoint takes up where it ended.
    """
    envelopes = raw_envelope(decode_records(records))
    if provider == ICEBERG:
        return timed(envelopes.writeStream.format(ICEBERG), checkpoint, trigger, once).toTable(target)
    if provider == PARQUET:
        writer = with_partition(envelopes).writeStream.format(PARQUET).partitionBy(PARTITION.name)
        ready = timed(writer, checkpoint, trigger, once)
        return ready.start(target) if "/" in target else ready.toTable(target)
    raise ValueError(f"unknown table provider: {provider}")


def start_preview(records: DataFrame, trigger: str | None = V.TRIGGER) -> StreamingQuery:
    """Print records as 'key → value' lines as they arrive."""
    lines = preview_lines(decode_records(records))
    writer = lines.writeStream.format("console").option("truncate", False)
    return writer.outputMode("append").trigger(processingTime=trigger_interval(trigger)).start()


def timed(
    writer: DataStreamWriter, checkpoint: str, trigger: str | None, once: bool
) -> DataStreamWriter:
    """A writer that takes what is there and ends, or goes on at every trigger."""
    kept = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        return kept.trigger(availableNow=True)
    return kept.trigger(processingTime=trigger_interval(trigger))
