"""Page tables to listing links and listing records, ready for the stream or a CSV file."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle import fixed_values as V
from parcelle.functions import bags, dates, places, text
from parcelle.operators import page_rules as rules
from parcelle.operators.pages import distinct_in_order, extract, having, positions
from parcelle.schemas import PAYLOAD_A, PAYLOAD_M


def listing_links_a(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """(page_id, pos, link) of the listings on result pages of source A."""
    found = extract(pages, _link_rules(V.LINK_SELECTORS_A), keep=["page_id"])
    hrefs = F.concat(*map(_or_empty, _tiers(V.LINK_SELECTORS_A)))
    links = F.transform(
        having(hrefs, V.LINK_PARTS_A), lambda href: text.absolute_url(href, V.BASE_URL_A)
    )
    return positions(found, F.array_distinct(links), limit)


def listing_links_m(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """(page_id, pos, link) of the listings on result pages of source M."""
    found = extract(pages, _link_rules(V.LINK_SELECTORS_M), keep=["page_id"])
    boxes, titles, others = map(_or_empty, _tiers(V.LINK_SELECTORS_M))
    links = F.filter(
        distinct_in_order(F.array(boxes, F.transform(titles, _rooted), F.transform(others, _rooted))),
        lambda link: link.startswith("http") & link.contains(V.LINK_PART_M),
    )
    return positions(found, links, limit)


def records_a(
    pages: DataFrame,
    mode: Column | str,
    seen_at: Column,
    selectors: Mapping[str, str] = V.SELECTORS_A,
    id_pattern: str = V.ID_PATTERN_A,
    image_host: str = V.IMAGE_HOST_A,
) -> DataFrame:
    """Listing pages of source A as payload rows.

    ``mode`` is the mode the pages were read in, ``seen_at`` the time: both may be
    columns of ``pages``.
    """
    at = selectors
    fields = extract(
        _read_in(pages, mode, seen_at),
        {
            "title": rules.text(at["title"]),
            "price_text": rules.text(at["price_text"]),
            "trail": rules.texts(at["breadcrumbs"]),
            "category": rules.text(at["category"]),
            "description": rules.text(at["description"]),
            "bag": rules.pairs(
                at["attribute"], at["attribute_label"], at["attribute_value"], at["attribute_icon"]
            ),
            "items": rules.texts(at["equipment"], inner=at["equipment_name"]),
            "seller_name": rules.text(at["seller_name"]),
            "shop": rules.present(at["shop_badge"]),
            "published": rules.text(at["published"], parent=True),
            "pictures": rules.values(at["images"], "src"),
        },
        keep=["page_id", "url", "_mode", "_seen_at"],
    )
    # A date out of the calendar makes a page unreadable, like any other problem on it.
    unreadable = dates.date_problem(F.col("published"), F.col("_seen_at"))
    made = [name for name in fields.columns if name not in ("page_id", "url", "_mode", "_seen_at", "error")]
    fields = fields.withColumn("error", F.coalesce("error", unreadable))
    fields = fields.withColumns({name: F.when(F.col("error").isNull(), F.col(name)) for name in made})
    return fields.select("page_id", *_in_order(PAYLOAD_A.names, {
        "id": text.id_from_url(F.col("url"), id_pattern),
        "breadcrumbs": bags.list_to_text(F.col("trail"), V.BREADCRUMB_SEPARATOR),
        "attributes": bags.json_or_null(F.col("bag")),
        "equipments": bags.list_to_text(F.col("items"), V.EQUIPMENT_SEPARATOR),
        "seller_type": F.when(F.col("shop"), V.SHOP_SELLER).when(~F.col("shop"), V.PRIVATE_SELLER),
        "published_date": dates.absolute_date(F.col("published"), F.col("_seen_at")),
        "image_urls": bags.list_to_text(_hosted(F.col("pictures"), image_host), V.IMAGE_SEPARATOR),
        "listing_type": places.offer_of_mode(F.col("_mode")),
    }))


def records_m(
    pages: DataFrame,
    mode: Column | str,
    selectors: Mapping[str, str] = V.SELECTORS_M,
    id_pattern: str = V.ID_PATTERN_M,
    image_host: str = V.IMAGE_HOST_M,
) -> DataFrame:
    """Listing pages of source M as payload rows."""
    at = selectors
    fields = extract(
        _read_in(pages, mode, F.lit(None).cast("timestamp")),
        {
            "title": rules.text(at["title"], glue=""),
            "price_text": rules.text(at["price"], glue=""),
            "location_text": rules.text(at["location"], glue=""),
            "amenities": rules.texts(at["amenities"], glue=""),
            "description_text": rules.text(
                at["description"], within=at["description_block"], glue=""
            ),
            "bag": rules.pairs(at["feature"], at["feature_label"], at["feature_value"]),
            "gallery": rules.values(at["gallery"], "src"),
            "slider": rules.values(at["slider"], "src"),
            "agency_name": rules.text(at["agency_name"], within=at["agency"], glue=""),
            "agency_links": rules.values(at["agency_link"], "href", within=at["agency"]),
        },
        keep=["page_id", "url", "_mode"],
    )
    agency = _rooted(F.get("agency_links", F.lit(0)))
    pictures = F.concat("gallery", "slider")
    return fields.select("page_id", *_in_order(PAYLOAD_M.names, {
        "id": text.id_from_url(F.col("url"), id_pattern),
        "listing_type": places.offer_of_mode(F.col("_mode")),
        "price": text.first_number(F.col("price_text")).cast("double"),
        "features_amenities_json": bags.json_or_null(F.col("amenities")),
        "features_main_json": bags.json_or_null(F.col("bag")),
        "gallery_urls": bags.json_or_null(_hosted(pictures, image_host)),
        "agency_url": F.when(agency.startswith("http"), agency),
        "published_date": F.lit(None).cast("string"),
    }))


def _read_in(pages: DataFrame, mode: Column | str, seen_at: Column) -> DataFrame:
    how = F.lit(mode) if isinstance(mode, str) else mode
    return pages.withColumns({"_mode": how, "_seen_at": seen_at.cast("timestamp")})


def _in_order(names: list[str], made: Mapping[str, Column]) -> list[Column]:
    """Payload columns in order: the computed ones, and the rest as they were extracted."""
    return [made.get(name, F.col(name)).alias(name) for name in names]


def _rooted(href: Column) -> Column:
    """Addresses from the root of source M made absolute; others as they are."""
    return F.when(href.startswith("/"), text.absolute_url(href, V.BASE_URL_M)).otherwise(href)


def _hosted(pictures: Column, host: str) -> Column:
    return F.array_distinct(having(pictures, [host]))


def _tiers(selectors: tuple[str, ...]) -> list[str]:
    return [f"tier_{i}" for i in range(len(selectors))]


def _link_rules(selectors: tuple[str, ...]) -> dict[str, rules.Rule]:
    return {
        name: rules.values(css, "linkref" if "[linkref]" in css else "href")
        for name, css in zip(_tiers(selectors), selectors)
    }


def _or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))
