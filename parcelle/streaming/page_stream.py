"""Pages to listing records as they arrive, with the pages that cannot be read kept apart.

A micro-batch is read once and goes two ways. Its folders are named by its number, so that a batch
which is done again after a failure takes the place of what it had written: every page is
there once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from parcelle import fixed_values as V
from parcelle.plans import page_records
from parcelle.streaming.raw_sink import timed

PAGE = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
])
#: What to do with the records of a batch, and its number: the same number means the same pages.
Deliver = Callable[[DataFrame, int], None]


def file_pages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """(page_id, url, html) out of a folder of Parquet files, as new files arrive."""
    reader = spark.readStream.schema(PAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def records_of(pages: DataFrame, source: str, mode: str) -> DataFrame:
    if source == V.SITE_A:
        return page_records.records_a(pages, mode, F.current_timestamp())
    return page_records.records_m(pages, mode)


def to_folder(path: str) -> Deliver:
    """Records as Parquet, a folder for each batch."""
    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")
    return write


def start_page_stream(
    pages: DataFrame,
    source: str,
    mode: str,
    records: Deliver,
    errors: Deliver,
    checkpoint: str,
    trigger: str | None = V.TRIGGER,
    once: bool = False,
) -> StreamingQuery:
    """Records of pages that can be read go to ``records``, (page_id, url, error) of the others to ``errors``.

    With ``once`` it takes what is there and ends. A restart on the same checkpoint takes up
    where it ended; a batch that had not ended is done again under its number.
    """
    def deliver(batch: DataFrame, number: int) -> None:
        # On disk where memory is short; a lost part is read from its pages again.
        rows = records_of(batch, source, mode).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            records(rows.where("error IS NULL").drop("page_id", "error"), number)
            errors(rows.where("error IS NOT NULL").select("page_id", "url", "error"), number)
        finally:
            rows.unpersist()

    return timed(pages.writeStream.foreachBatch(deliver), checkpoint, trigger, once).start()
