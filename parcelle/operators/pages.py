"""Page tables: links, pictures and fields, partition by partition, without a shuffle."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.functions.html import attribute_values
from parcelle.functions.text import absolute_url
from parcelle.operators import page_rules
from parcelle.operators.page_rules import Reader, Rule

# The rules travel with the task, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(page_rules)


_ARROW = {
    "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()),
    "map<string,string>": pa.map_(pa.string(), pa.string()),
}


def extract(
    pages: DataFrame,
    rules: Mapping[str, Rule],
    keep: Sequence[str] = ("page_id", "url"),
    html: str = "html",
) -> DataFrame:
    """One row per page: the kept columns, one column per rule, and ``error``.

    A page that cannot be read gives a row with ``error`` set and nothing else, and
    the job goes on. A task makes one automaton of all rules and reads a page once.
    """
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema)
    made = ", ".join(f"`{name}` {rule.type}" for name, rule in rules.items())
    names = [*keep, *rules, "error"]
    rules = dict(rules)

    def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None

        def read(page: str | None) -> tuple:
            nonlocal reader
            try:
                if page is None:
                    raise ValueError("page has no text")
                if reader is None:
                    reader = Reader(list(rules.values()))
                return (*reader.read(page), None)
            except Exception as problem:
                return (*(None for _ in rules), str(problem) or type(problem).__name__)

        for batch in batches:
            rows = [read(page.as_py()) for page in batch.column(len(keep))]
            fields = [
                pa.array([tuple(v.items()) if isinstance(v, dict) else v for v in taken], _ARROW[kind])
                for kind, taken in zip([*(rule.type for rule in rules.values()), "string"], zip(*rows) if rows else [()] * (len(rules) + 1))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *fields], names)

    return pages.select(*keep, html).mapInArrow(
        read_batches, schema=f"{kept}, {made}, `error` string"
    )


def distinct_in_order(lists: Column) -> Column:
    """Items of a list of lists, each kept where it is met first."""
    return F.array_distinct(F.flatten(lists))


def having(addresses: Column, parts: Sequence[str]) -> Column:
    """Addresses that contain every one of the parts."""
    def has_all(address: Column) -> Column:
        kept = F.lit(True)
        for part in parts:
            kept = kept & address.contains(part)
        return kept

    return F.filter(addresses, has_all)


def page_links(
    pages: DataFrame,
    base: str,
    parts: Sequence[str] = (),
    limit: int | None = None,
    tag: str = "a",
    attribute: str = "href",
) -> DataFrame:
    """(page_id, pos, link): absolute links of each page in page order, each once.

    ``parts`` must all occur in the address as written; ``limit`` is per page.
    """
    found = having(attribute_values(F.col("html"), tag, attribute), parts)
    links = F.array_distinct(F.transform(found, lambda href: absolute_url(href, base)))
    return positions(pages, links, limit)


def positions(pages: DataFrame, links: Column, limit: int | None) -> DataFrame:
    """A list column as rows of (page_id, pos, link), cut to ``limit`` per page."""
    cut = links if limit is None else F.slice(links, 1, limit)
    return pages.select("page_id", F.posexplode(cut).alias("pos", "link"))


def first_links(links: DataFrame, limit: int | None = None) -> DataFrame:
    """Links over all pages, each where it is met first, in crawl order.

    A link is there once per page, as :func:`page_links` gives it, so the first page
    decides; that keeps the aggregate on fixed-width numbers, and hashed. Sightings
    are reduced before the shuffle, and ``limit`` keeps that many rows per task.
    """
    first = links.groupBy("link").agg(
        F.min("page_id").alias("page_id"), F.min_by("pos", "page_id").alias("pos")
    )
    ordered = first.orderBy("page_id", "pos")
    return ordered if limit is None else ordered.limit(limit)


def page_images(pages: DataFrame, host: str) -> DataFrame:
    """(page_id, images): picture addresses that contain ``host``, each once, in page order."""
    found = having(attribute_values(F.col("html"), "img", "src"), [host])
    return pages.select("page_id", F.array_distinct(found).alias("images"))


def label_values(pages: DataFrame, rule: Rule) -> DataFrame:
    """(page_id, label, value) of the label/value pairs of each page."""
    return extract(pages, {"pairs": rule}, keep=["page_id"]).select(
        "page_id", F.explode("pairs").alias("label", "value")
    )
