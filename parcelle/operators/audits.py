"""Audits that are counted while rows pass, in the job that writes them."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.schemas import only


READ = ("rows", "malformed", "id_mismatch")
WRITTEN = ("rows", "null_price", "offer_mismatch")


class Audit:
    """Counts of what a job reads and what it writes, ready when its write has ended.

    Nothing is read for it again: the counts are observed on the rows on their way.
    """

    def __init__(self) -> None:
        self._read, self._written = Observation("read"), Observation("written")

    def of_read(self, raw: DataFrame, schema: T.StructType) -> DataFrame:
        """Envelopes, with those counted that hold no JSON object or the document of another id."""
        own = F.from_json("payload", only(schema, "id"))["id"]
        return raw.observe(
            self._read, F.count("*").alias("rows"), F.count_if(F.json_object_keys("payload").isNull()).alias("malformed"),
            F.count_if(own != F.col("id")).alias("id_mismatch"),
        )

    def of_written(self, rows: DataFrame) -> DataFrame:
        """Unified rows, with those counted that have no price or an offer that their category does not confirm."""
        return rows.observe(
            self._written, F.count("*").alias("rows"), F.count_if(F.col("price").isNull()).alias("null_price"),
            F.count_if(~F.col("offre_match")).alias("offer_mismatch"),
        )

    def report(self) -> dict[str, dict[str, int]]:
        """Waits for the write that the rows go into."""
        return {"read": _counts(self._read, READ), "written": _counts(self._written, WRITTEN)}


def _counts(observed: Observation, names: tuple[str, ...]) -> dict[str, int]:
    try:
        found = observed.get
    except Py4JJavaError:
        # Where Spark finds out on the way that there are no rows, it drops the step that counts them.
        found = {}
    return {name: found.get(name, 0) for name in names}
