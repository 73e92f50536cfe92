"""Record streams on Kafka. The connector has to be on the session's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelle import fixed_values as V
from parcelle.operators.payloads import kafka_records

EARLIEST = "earliest"
LATEST = "latest"


def source_options(bootstrap: str, topic: str, starting: str = LATEST) -> dict[str, str]:
    if starting not in (EARLIEST, LATEST):
        raise ValueError(f"starting offsets are {EARLIEST} or {LATEST}, not {starting}")
    return {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting,
    }


def sink_options(bootstrap: str, topic: str) -> dict[str, str]:
    """Idempotent writes acknowledged by all replicas, in small compressed batches."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, **V.PRODUCER_OPTIONS}


def record_stream(
    spark: SparkSession,
    bootstrap: str,
    topic: str,
    starting: str = LATEST,
    records_per_trigger: int | None = None,
) -> DataFrame:
    """An endless stream of (key, value) records from one topic.

    ``starting`` counts only until there is a checkpoint. ``records_per_trigger``
    bounds a micro-batch, so that catching up on a long topic takes many commits of
    even size and not a single one.
    """
    options = source_options(bootstrap, topic, starting)
    if records_per_trigger:
        options["maxOffsetsPerTrigger"] = str(records_per_trigger)
    return spark.readStream.format("kafka").options(**options).load().select("key", "value")


def record_batch(spark: SparkSession, bootstrap: str, topic: str) -> DataFrame:
    """The records a topic holds now."""
    options = source_options(bootstrap, topic, EARLIEST)
    return spark.read.format("kafka").options(**options).load().select("key", "value")


def write_records(rows: DataFrame, bootstrap: str, topic: str, key: str = "id") -> None:
    """Rows to a topic, one JSON document each, from all partitions at once."""
    records = kafka_records(rows, key)
    records.write.format("kafka").options(**sink_options(bootstrap, topic)).save()
