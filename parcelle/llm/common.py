"""What several corpus operators share: reading, cutting lineage, words as numbers."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Words kept at hand by a task; beyond that it starts anew, which costs time and changes nothing.
MOST_KEPT = 1_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows as files in ``spark.checkpoint.dir``, which every executor can read.

    Only a session without that setting, as in tests, gets a folder of its own.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder for what jobs hand on to each other. A cluster has to name it."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        given = spark.conf.get("spark.checkpoint.dir", None)
        if not given and context.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(given or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def remove(spark: SparkSession, folder: str) -> None:
    """Removes a folder that was handed on and is read no more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, most_rows: int = 20_000) -> DataFrame:
    """A hint to broadcast a table that was counted and found small; else the table as it is."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def by_batch(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """Rows turned batch by batch inside tasks; ``make`` runs once in each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = make()
        for batch in batches:
            if batch.num_rows:
                yield turn(batch)
    return df.mapInArrow(run, schema)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; a missing text is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def hash64(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


class Words(dict):
    """Word to row number in columns of facts about words, which ``facts`` gives for a new word."""

    def __init__(self, facts: Callable[[bytes], tuple], kinds: list):
        super().__init__()
        self.facts, self.kinds = facts, kinds
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.columns = [np.zeros(4096, kind) for kind in self.kinds]

    def __missing__(self, word: bytes) -> int:
        at = len(self)
        if at == len(self.columns[0]):
            self.columns = [np.concatenate([c, np.zeros_like(c)]) for c in self.columns]
        for column, value in zip(self.columns, self.facts(word)):
            column[at] = value
        self[word] = at
        return at

    def rows(self, words: list[bytes]) -> np.ndarray:
        if len(self) > MOST_KEPT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers with all bits spread (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of ``width`` words; shorter sequences give one for the whole, none give none."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    key = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        key = (key ^ hashes[k:n - width + 1 + k]) * _MIX
        key ^= key >> np.uint64(29)
    return mixed(key)
