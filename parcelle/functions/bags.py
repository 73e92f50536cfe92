"""Lists and attribute bags kept inside text fields."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelle import fixed_values as V
from parcelle.functions.text import column_name, label_to_column, literal_map
from parcelle.schemas import TEXT_LIST, TEXT_MAP


def computed_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def split_list(text: Column, separator: str) -> Column:
    """Trimmed, non-empty items of a delimited text; NULL stays NULL."""
    items = F.split(text, rf"\s*{separator}\s*")
    return F.filter(F.transform(items, F.trim), lambda item: item != "")


def piped_images(text: Column) -> Column:
    return split_list(text, r"\|")


def json_list(text: Column) -> Column:
    """A JSON array of texts; anything else is NULL."""
    return F.from_json(text, TEXT_LIST)


def equipment_list(text: Column) -> Column:
    """Distinct equipment names in order of appearance; no text is an empty list.

    Left out are items without a Latin letter, with a digit, that contain a month
    word, or that are one of the barred words.
    """
    def is_equipment(item: Column) -> Column:
        word = F.lower(item)
        return (
            item.rlike(V.EQUIPMENT_NEEDS)
            & ~item.rlike(V.EQUIPMENT_BARS)
            & ~word.contains(V.EQUIPMENT_BARRED_PART)
            & ~word.isin(*V.EQUIPMENT_BARRED_WORDS)
        )

    items = F.transform(F.split(text, r"\s*;\s*"), F.trim)
    named = F.array_distinct(F.filter(items, is_equipment))
    return F.coalesce(named, F.array().cast(TEXT_LIST))


def attribute_map(text: Column) -> Column:
    """A JSON object as raw label → value; anything else is NULL."""
    return F.from_json(text, TEXT_MAP)


def named_attributes(bag: Column) -> Column:
    """Column name → trimmed value.

    Labels that give no name are dropped; of labels with the same name in one bag
    the smallest raw label counts. Names of the usual labels are looked up, so that
    only unusual ones are folded row by row.
    """
    usual = literal_map({label: label_to_column(label) for label in V.LABELS_A + V.LABELS_M})
    entries = F.transform(
        F.sort_array(F.map_entries(bag)),
        lambda e: F.struct(
            F.coalesce(usual[e["key"]], column_name(e["key"])).alias("name"),
            F.trim(e["value"]).alias("value"),
        ),
    )

    def first_of_each(rows: Column) -> Column:
        names = rows["name"]
        return F.map_from_entries(F.filter(
            rows,
            lambda row, at: (row["name"] != "") & (F.array_position(names, row["name"]) == at + 1),
        ))

    return computed_once(entries, first_of_each)


def list_to_text(items: Column, separator: str) -> Column:
    """Items in one text; an empty list is NULL."""
    return F.nullif(F.array_join(items, separator), F.lit(""))


def json_or_null(value: Column) -> Column:
    """A map or list as JSON text; an empty one is NULL."""
    return F.when(F.size(value) > 0, F.to_json(value))
