"""Counts, frequencies and audits over raw and unified tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.functions.text import price_from_text


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def malformed_rows(raw: DataFrame) -> DataFrame:
    """How many envelopes there are, and how many hold no readable JSON object."""
    broken = F.json_object_keys("payload").isNull()
    return raw.agg(F.count("*").alias("rows"), F.count_if(broken).alias("malformed"))


def value_counts(df: DataFrame, *columns: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first; ties by value so that ``top`` is repeatable.

    Counts are combined before the shuffle, so a value with most of the rows costs
    one row per task.
    """
    counted = (
        df.groupBy(*columns).agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), *columns)
    )
    return counted if top is None else counted.limit(top)


def duplicate_ids(df: DataFrame, key: str = "id") -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    return (
        df.groupBy(key).agg(F.count("*").alias("count"))
        .filter("count > 1")
        .orderBy(F.desc("count"), key)
    )


def group_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("count"))


def mean_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(name))


def id_mismatch(parsed: DataFrame) -> DataFrame:
    """Rows whose document id is not the envelope's."""
    return parsed.select("id", "record_id").filter(F.col("id") != F.col("record_id"))


def offer_mismatch(df: DataFrame, match: str = "offre_match") -> DataFrame:
    """Rows whose category phrase does not confirm the offer."""
    return df.filter(~F.col(match))


def price_quality(df: DataFrame, text: str = "price_text") -> DataFrame:
    """How many price texts are missing, and how many prices after cleaning."""
    missing = F.col(text).isNull() | (F.length(text) == 0)
    return df.agg(
        F.count_if(missing).alias("null_price_text"),
        F.count_if(price_from_text(F.col(text)).isNull()).alias("null_price"),
    )


def flatten_breaks(df: DataFrame, also: Mapping[str, Column] | None = None) -> DataFrame:
    """Line breaks and tabs in text columns become a space, for a readable preview."""
    texts = {
        f.name: F.regexp_replace(f.name, r"[\r\n\t]+", " ")
        for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    }
    return df.withColumns({**texts, **(also or {})})


def preview(df: DataFrame, rows: int = 10, *order: str) -> DataFrame:
    """A few flattened rows, small enough for ``toPandas``; limited before anything else."""
    head = df.orderBy(*order) if order else df
    return flatten_breaks(head.limit(rows))
