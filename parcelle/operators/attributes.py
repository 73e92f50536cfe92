"""Attribute bags as columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.functions.bags import attribute_map, named_attributes
from parcelle.functions.text import column_name, label_to_column

def distinct_keys(df: DataFrame, bag: Column) -> DataFrame:
    """Every raw label that occurs in a bag, once."""
    return df.select(F.explode(F.map_keys(bag)).alias("k")).distinct()


def sanitized_keys(keys: DataFrame) -> DataFrame:
    """Raw labels with the column name each one stands for."""
    return keys.select("k", column_name(F.col("k")).alias("name"))


def labelled_attributes(
    df: DataFrame, column: str, labels: Sequence[str], raw: Mapping[str, str] | None = None, more: Sequence[str] = ()
) -> DataFrame:
    """Adds one trimmed column per label out of a JSON object of attributes.

    ``raw`` names columns for values as they are, of exactly these labels, ``more`` columns for
    whatever labels give these names.

    The object is read once, into a map. Almost every object has no labels but the given
    ones, spelled as given, which are looked up there. Of objects with any other label the
    labels are turned into names, since another spelling may stand for the same column.
    Both ways give the same for objects of the first kind.
    """
    bag, named = F.col("_map"), F.col("_named")
    others = F.array_except(F.map_keys(bag), F.split(F.lit("\n".join(labels)), "\n"))
    read = df.withColumn("_map", attribute_map(F.col(column)))
    read = read.withColumn("_named", F.when(F.size(others) > 0, named_attributes(bag)))
    return read.withColumns({
        label_to_column(label): F.when(named.isNotNull(), named[label_to_column(label)]).otherwise(F.trim(bag[label]))
        for label in labels
    }).withColumns({
        **{name: bag[label] for name, label in (raw or {}).items()},
        # A label that is not among the given ones makes its object one of the second kind.
        **{name: named[name] for name in more},
    }).drop("_map", "_named")


def pivoted_attributes(df: DataFrame, bag: Column, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One column for each of the attribute ``names``, next to the ``keep`` columns.

    Names already in ``keep`` are not overwritten. One projection, without a pass to
    find names; :func:`attribute_rows` holds whatever names there are.
    """
    named = df.select(*keep, named_attributes(bag).alias("_named"))
    return named.select(*keep, *(F.col("_named")[name].alias(name) for name in names if name not in keep))


def attribute_rows(df: DataFrame, bag: Column, keep: Sequence[str]) -> DataFrame:
    """A row for each attribute of each row: the ``keep`` columns, ``name`` and ``value``.

    The open form of :func:`pivoted_attributes`: any number of names, and no shuffle.
    """
    return df.select(*keep, F.explode(named_attributes(bag)).alias("name", "value"))
