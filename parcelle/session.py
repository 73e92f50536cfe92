"""Spark session for jobs, tests and the benchmark."""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

# Timestamps are compared and formatted in UTC everywhere; the rest of the
# cluster's own settings (executors, shuffle partitions, memory) is left alone.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Plans here have thousands of expressions; noting the caller of each is slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "8g",
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
}


def iceberg_conf(catalog: str, uri: str, warehouse: str, **io: str) -> dict[str, str]:
    """Settings of a REST lake catalog. Secrets come from the caller's environment.

    ``io`` holds further catalog properties with ``__`` for a dot in the name,
    e.g. ``s3__endpoint="http://store:9000"``.
    """
    prefix = f"spark.sql.catalog.{catalog}"
    conf = {
        "spark.sql.extensions":
            "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.type": "rest",
        f"{prefix}.uri": uri,
        f"{prefix}.warehouse": warehouse,
        "spark.sql.defaultCatalog": catalog,
    }
    for name, value in io.items():
        conf[f"{prefix}.{name.replace('__', '.')}"] = value
    return conf


def build_session(
    app_name: str,
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session; ``master`` is set for local runs only, spark-submit sets it otherwise."""
    builder = SparkSession.builder.appName(app_name)
    settings = dict(ENGINE_CONF)
    if master:
        builder = builder.master(master)
        settings.update(LOCAL_CONF)
        settings["spark.sql.shuffle.partitions"] = str(_local_cores(master))
    settings.update(conf or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def _local_cores(master: str) -> int:
    inside = master.partition("[")[2].rstrip("]")
    return int(inside) if inside.isdigit() else (os.cpu_count() or 8)


# Spark gives this size, or more, to a relation whose size it does not know.
_UNKNOWN_SIZE = 1 << 60
_SETTING = "spark.sql.shuffle.partitions"


def shuffle_partitions_for(df: DataFrame, bytes_per_partition: int = 128 << 20) -> int:
    """Shuffle partitions that an input needs, the session's own at least.

    Adaptive execution merges partitions that turn out small but never adds any, so
    the number has to fit the largest shuffle, which carries the input's payloads.
    The size is that of the files left after partition pruning; where Spark does not
    know it, the session's own number stands.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    own = int(df.sparkSession.conf.get(_SETTING))
    return own if size >= _UNKNOWN_SIZE else max(own, -(-size // bytes_per_partition))


def scan_tasks(df: DataFrame) -> int:
    """Tasks that reading an input takes, by the size of its files; 1 where Spark does not know it."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    split = df.sparkSession.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"))
    return 1 if size >= _UNKNOWN_SIZE else max(1, -(-size // split))


@contextlib.contextmanager
def sized_shuffles(df: DataFrame, bytes_per_partition: int = 128 << 20) -> Iterator[int]:
    """Within it, shuffles have as many partitions as the input needs; after it, as before."""
    spark = df.sparkSession
    before = spark.conf.get(_SETTING)
    partitions = shuffle_partitions_for(df, bytes_per_partition)
    spark.conf.set(_SETTING, str(partitions))
    try:
        yield partitions
    finally:
        spark.conf.set(_SETTING, before)
