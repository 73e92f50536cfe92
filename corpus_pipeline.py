"""From raw documents to packed token sequences, stage by stage.

Each stage takes the documents that the one before it kept, as it wrote them, and all but the
last return their columns.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from parcelle.llm.common import documents, remove, shared_folder
from parcelle.llm.decontaminate import without_leaks
from parcelle.llm.near_dedup import without_duplicates
from parcelle.llm.packing import pack_documents
from parcelle.llm.quality import without_outliers
from parcelle.llm.secrets import mask_secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the fixed rules nor are outliers of their language and source."""
    return without_outliers(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return without_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked."""
    return mask_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: SQL can express neither the estimates nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the documents; what one hands on lies in the shared folder until the next is written."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid4()}"
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        if number:
            remove(spark, f"{folder}/{number - 1}")
    return docs
