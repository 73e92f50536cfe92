"""RAW envelopes to the unified listing table.

One job per source, without a pass to find attribute labels: freshness filter on
the scan, versions told apart on (id, ingest_ts, payload), the full parse only for
the rows that are left, and one projection driven by the target schema.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle import fixed_values as V
from parcelle.functions import bags, places, text
from parcelle.operators.attributes import labelled_attributes
from parcelle.operators.audits import Audit
from parcelle.operators.payloads import key_by_document, parse_payload
from parcelle.operators.versions import fresh_window, latest_per_key, spread_for
from parcelle.schemas import PAYLOAD_A, PAYLOAD_M, SILVER
from parcelle.session import scan_tasks


#: Payload fields that a unified column is made of, where it is not the field of its own name.
_MADE_OF_A = {
    "offre": ("listing_type",), "price": ("price_text",), "seller": ("seller_name",), "city": ("breadcrumbs",),
    "neighborhood": ("breadcrumbs",), "property_type": ("category",), "images": ("image_urls",),
    "description_text": ("description",), "offre_match": ("category", "listing_type"),
    **{text.label_to_column(label): ("attributes",) for label in V.LABELS_A},
}
_MADE_OF_M = {
    "offre": ("listing_type",), "seller": ("agency_name",), "city": ("location_text",),
    "neighborhood": ("location_text",), "property_type": ("features_main_json",), "images": ("gallery_urls",),
    **{text.label_to_column(label): ("features_main_json",) for label in V.LABELS_M},
}


def unified(
    df: DataFrame, columns: Mapping[str, Column], wanted: Sequence[str] | None = None, more: Sequence[str] = ()
) -> DataFrame:
    """The unified columns in order, or of them the wanted ones, and ``more`` columns as they are.

    Each is the given expression, else the column of that name, else a NULL of its type.
    """
    there = set(df.columns)
    nothing = {kind: F.lit(None).cast(kind) for kind in {f.dataType for f in SILVER.fields}}

    def column(field: T.StructField) -> Column | str:
        if field.name in columns:
            made = columns[field.name]
            # Lists differ in whether they may hold NULLs; all else has its type already.
            listed = isinstance(field.dataType, T.ArrayType)
            return (made.cast(field.dataType) if listed else made).alias(field.name)
        if field.name in there:
            return field.name
        return nothing[field.dataType].alias(field.name)

    return df.select(*(column(f) for f in SILVER.fields if wanted is None or f.name in wanted), *more)


def fields_for(schema: T.StructType, made_of: Mapping[str, Sequence[str]], wanted: Sequence[str] | None) -> list[str] | None:
    """Payload fields that the wanted unified columns need; None for all."""
    if wanted is None:
        return None
    needed = {name for column in wanted for name in made_of.get(column, (column,))}
    return [name for name in schema.names if name in needed]


def latest_documents(
    raw: DataFrame,
    schema: T.StructType,
    minutes: int = 0,
    as_of: dt.datetime | Column | None = None,
    fields: Sequence[str] | None = None,
    audit: Audit | None = None,
) -> DataFrame:
    """The newest document of each listing, parsed as far as ``fields`` go, with an address.

    The address is looked at last: a listing whose newest version has none is gone,
    whatever its older versions had.
    """
    fresh = fresh_window(raw, minutes, as_of)
    keyed = key_by_document(audit.of_read(fresh, schema) if audit else fresh, schema)
    newest = latest_per_key(keyed, spread=spread_for(scan_tasks(raw)))
    return parse_payload(newest.filter("addressed"), schema, fields)


def silver_a(
    raw: DataFrame, minutes: int = 0, as_of: dt.datetime | Column | None = None, columns: Sequence[str] | None = None,
    audit: Audit | None = None, more: Sequence[str] = (),
) -> DataFrame:
    """Source A in unified form; with ``columns`` no more is read of a document than these need.

    ``audit`` counts what is read. ``more`` are names of columns for labels that are not in the
    unified table, for whole rows only.
    """
    c = F.col
    listings = latest_documents(raw, PAYLOAD_A, minutes, as_of, fields_for(PAYLOAD_A, _MADE_OF_A, columns), audit)
    there = set(listings.columns)
    if "breadcrumbs" in there:
        listings = listings.withColumn("_place", places.breadcrumb_place(c("breadcrumbs")))
    if "category" in there:
        listings = listings.withColumn("_category", places.category_parts(c("category")))
    if "attributes" in there:
        listings = labelled_attributes(listings, "attributes", V.LABELS_A, more=more)
    made = {
        "site": F.lit(V.SITE_A),
        "offre": c("listing_type"),
        "price": text.price_from_text(c("price_text")),
        "seller": text.seller_name(c("seller_name"), V.SELLER_PLACEHOLDERS_A),
        "city": c("_place.city"),
        "neighborhood": c("_place.neighborhood"),
        "property_type": c("_category.property_type"),
        "images": bags.piped_images(c("image_urls")),
        "equipments": bags.equipment_list(c("equipments")),
        "description_text": c("description"),
        "offre_match": places.offer_matches(c("_category.phrase"), c("listing_type")),
    }
    return unified(listings, made, columns, more)


def silver_m(
    raw: DataFrame, minutes: int = 0, as_of: dt.datetime | Column | None = None, columns: Sequence[str] | None = None,
    audit: Audit | None = None, more: Sequence[str] = (),
) -> DataFrame:
    """Source M in unified form; with ``columns`` no more is read of a document than these need.

    ``audit`` counts what is read. ``more`` are names of columns for labels that are not in the
    unified table, for whole rows only.
    """
    c = F.col
    listings = latest_documents(raw, PAYLOAD_M, minutes, as_of, fields_for(PAYLOAD_M, _MADE_OF_M, columns), audit)
    there = set(listings.columns)
    if "location_text" in there:
        listings = listings.withColumn("_place", places.paired_place(c("location_text")))
    if "features_main_json" in there:
        listings = labelled_attributes(listings, "features_main_json", V.LABELS_M, {"_type": V.PROPERTY_TYPE_LABEL}, more)
    made = {
        "site": F.lit(V.SITE_M),
        "offre": c("listing_type"),
        "price": text.positive_price(c("price")),
        "seller": text.seller_name(c("agency_name"), V.SELLER_PLACEHOLDERS_M),
        "city": c("_place.city"),
        "neighborhood": c("_place.neighborhood"),
        "property_type": c("_type"),
        "images": bags.json_list(c("gallery_urls")),
    }
    return unified(listings, made, columns, more)


SILVER_PLANS: Mapping[str, Callable[..., DataFrame]] = {
    V.SITE_A: silver_a,
    V.SITE_M: silver_m,
}


def silver_all(
    raw_a: DataFrame,
    raw_m: DataFrame,
    minutes: int = 0,
    as_of: dt.datetime | Column | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Both sources in one table."""
    return silver_a(raw_a, minutes, as_of, columns).unionByName(silver_m(raw_m, minutes, as_of, columns))


def latest_listings(silver: DataFrame) -> DataFrame:
    """The newest row of each listing of each site.

    The unified table is append-only and its jobs look back further than they run
    apart, so it may hold a version several times.
    """
    return latest_per_key(silver, ("site", "id"), ties=("url", "title"))
