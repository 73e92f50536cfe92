"""Queries over the page table."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelle import fixed_values as V
from parcelle.functions import bags, html, text
from parcelle.operators import page_rules as rules
from parcelle.operators import pages as page_ops
from parcelle.plans import page_records
from parcelle.queries import inputs as I
from parcelle.queries.listings import LIST_MARK, _joined
from parcelle.queries.registry import query

SITE = "https://example.test"
IMAGE_HOST = "cdn.example.test/"

GIVEN_ID = r"/(\d+)"

c = F.col


# --- checking SQL ------------------------------------------------------------

def _plain(text_sql: str) -> str:
    for entity, char in (
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
    ):
        text_sql = f"replace({text_sql}, '{entity}', '{char}')"
    return text_sql


def _clean(text_sql: str) -> str:
    collapsed = rf"regexp_replace({text_sql}, '[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+', ' ', 'g')"
    return f"nullif(trim({collapsed}), '')"


HREFS = "list_transform(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1), lambda x: " + _plain("x") + ")"
LINK_TEXTS = (
    "list_filter(list_transform(regexp_extract_all(html, '<a href=\"[^\"]*\">([^<]*)</a>', 1), lambda x: "
    + _clean(_plain("x")) + "), lambda x: x IS NOT NULL)"
)
URL_ID = r"nullif(regexp_extract(url, '/(\d+)', 1), '')"
def _links_of(pages: str, hrefs: str = HREFS) -> str:
    """(page_id, pos, link) of a page table, each link of a page where it is met first."""
    return f"""
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY spot) - 1 AS INTEGER) AS pos, link FROM (
 SELECT page_id, link, min(spot) AS spot FROM (
  SELECT page_id, concat('{SITE}', unnest(hrefs)) AS link, generate_subscripts(hrefs, 1) AS spot FROM (SELECT page_id, {hrefs} AS hrefs FROM {pages}))
 GROUP BY page_id, link)"""


LINKS = _links_of("pages")
HAS_PARTS = " AND ".join(f"contains(x, '{part}')" for part in V.LINK_PARTS_A)
LISTING_LINKS = _links_of("listed", f"list_filter({HREFS}, lambda x: {HAS_PARTS})")


# --- links and pictures ------------------------------------------------------

@query(LINKS)
def page_links(spark, sf_dir):
    return page_ops.page_links(I.table(spark, sf_dir, "pages"), SITE)


@query(f"""
WITH listed AS ({I.LISTED_PAGES})
SELECT link, page_id, pos FROM (
 SELECT *, row_number() OVER (PARTITION BY link ORDER BY page_id, pos) AS nth FROM ({LISTING_LINKS}) WHERE pos < 3)
WHERE nth = 1 ORDER BY page_id, pos LIMIT 25""")
def page_links_capped(spark, sf_dir):
    listed = I.derived(spark, sf_dir, I.LISTED_PAGES, "pages")
    return page_ops.first_links(page_ops.page_links(listed, SITE, parts=V.LINK_PARTS_A, limit=3), 25)


@query(f"""
SELECT link, page_id, pos FROM (
 SELECT *, row_number() OVER (PARTITION BY link ORDER BY page_id, pos) AS nth FROM ({LINKS}))
WHERE nth = 1""")
def page_links_unique(spark, sf_dir):
    return page_ops.first_links(page_ops.page_links(I.table(spark, sf_dir, "pages"), SITE))


@query(f"""
WITH pictures AS ({I.PICTURE_PAGES}), sources AS (
 SELECT page_id, list_filter(list_transform(regexp_extract_all(html, 'src="([^"]*)"', 1),
  lambda x: {_plain('x')}), lambda x: contains(x, '{IMAGE_HOST}')) AS found FROM pictures)
SELECT page_id, {_joined('list_filter(found, lambda x, i: list_position(found, x) = i)')} AS images FROM sources""")
def page_images(spark, sf_dir):
    pictures = I.derived(spark, sf_dir, I.PICTURE_PAGES, "pages")
    found = page_ops.page_images(pictures, IMAGE_HOST)
    return found.withColumn("images", F.array_join("images", LIST_MARK))


# --- listing links ----------------------------------------------------------

def _links_sql(*tiers: str) -> str:
    """(page_id, pos, link) of the tiers in order, each link where it is met first."""
    return f"""
WITH found AS (SELECT page_id, tiers FROM (SELECT o_orderkey AS page_id, [{', '.join(tiers)}] AS tiers FROM orders WHERE o_orderkey % 13 <> 0)),
 spots AS (SELECT page_id, unnest(tiers) AS link, generate_subscripts(tiers, 1) AS spot FROM found),
 firsts AS (SELECT page_id, link, min(spot) AS spot FROM spots GROUP BY page_id, link)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY spot) - 1 AS INTEGER) AS pos, link FROM firsts"""


@query(_links_sql(
    f"concat('{V.BASE_URL_A}/fr/b_', CAST(o_orderkey AS VARCHAR), '.htm')", f"concat('{V.BASE_URL_A}/fr/d_', CAST(o_orderkey % 10 AS VARCHAR), '.htm')",
    f"concat('{V.BASE_URL_A}/fr/c_', CAST(o_orderkey % 100 AS VARCHAR), '.htm')"))
def listing_links_a(spark, sf_dir):
    return page_records.listing_links_a(I.result_pages(spark, sf_dir, "a"))


@query(_links_sql(
    f"concat('{V.BASE_URL_M}/fr/a/', CAST(o_orderkey AS VARCHAR), '/b')", f"concat('{V.BASE_URL_M}/fr/a/', CAST(o_orderkey % 100 AS VARCHAR), '/c')",
    f"concat('{V.BASE_URL_M}/fr/a/', CAST(o_orderkey % 10 AS VARCHAR), '/d')"))
def listing_links_m(spark, sf_dir):
    return page_records.listing_links_m(I.result_pages(spark, sf_dir, "m"))


# --- fields ------------------------------------------------------------------

SEEN = "2025-11-02 10:00:00"


def _read(readable: str, columns: dict[str, str]) -> str:
    """Columns of pages that can be read, and NULLs for the others."""
    return ", ".join(f"CASE WHEN {readable} THEN {made} END AS {name}" for name, made in columns.items())


@query(f"""
WITH rows_a AS ({I.PAGE_ROWS_A})
SELECT page_id, CAST(page_id AS VARCHAR) AS id, url, 'vente' AS listing_type,
 CASE WHEN nothing = 0 THEN 'page has no text' WHEN age LIKE '%9000%' THEN 'date value out of range' END AS error,
 {_read("nothing <> 0 AND coalesce(age, '') NOT LIKE '%9000%'", {
    "title": "title", "price_text": "price", "breadcrumbs": "'Accueil > Tout le Maroc'", "category": "category",
    "description": "concat(said, ' Fin')", "attributes": """CASE WHEN rooms IS NOT NULL THEN concat('{"Chambres":"', rooms, '"}') END""",
    "equipments": "'Parking'", "seller_name": "concat('Agence ', said)", "seller_type": "CASE shop WHEN 1 THEN 'Boutique' ELSE 'Particulier' END",
    "published_date": f"CASE WHEN age LIKE '%jours' THEN '2025-10-31 10:00:00' WHEN age IS NOT NULL THEN '{SEEN}' END",
    "image_urls": "picture"})}
FROM rows_a""")
def page_fields(spark, sf_dir):
    return page_records.records_a(I.listing_pages(spark, sf_dir, "a"), "vendre", F.lit(SEEN).cast("timestamp"))


@query(f"""
WITH rows_m AS ({I.PAGE_ROWS_M})
SELECT page_id, CAST(page_id AS VARCHAR) AS id, url, 'location' AS listing_type, CAST(NULL AS VARCHAR) AS published_date,
 CASE WHEN nothing = 0 THEN 'page has no text' END AS error,
 {_read("nothing <> 0", {
    "title": "title", "price": "CASE WHEN thousands >= 0 THEN CAST(thousands * 1000 AS DOUBLE) END", "location_text": "place",
    "features_amenities_json": """CASE WHEN amenity IS NULL THEN '["Jardin"]' ELSE '["Jardin","Terrasse"]' END""",
    "description_text": "'Belle vue'", "features_main_json": """CASE WHEN kind IS NOT NULL THEN concat('{"Type de bien":"', kind, '"}') END""",
    "gallery_urls": """CASE WHEN picture IS NOT NULL THEN concat('["', picture, '"]') END""", "agency_name": "agency",
    "agency_url": f"CASE WHEN agency IS NOT NULL THEN '{V.BASE_URL_M}/fr/agence/1' END"})}
FROM rows_m""")
def page_fields_m(spark, sf_dir):
    return page_records.records_m(I.listing_pages(spark, sf_dir, "m"), "louer")


@query(f"""
WITH rows_m AS ({I.PAGE_ROWS_M})
SELECT page_id, 'Type de bien' AS label, kind AS value FROM rows_m WHERE nothing <> 0 AND kind IS NOT NULL""")
def page_label_values(spark, sf_dir):
    at = V.SELECTORS_M
    rule = rules.pairs(at["feature"], at["feature_label"], at["feature_value"])
    return page_ops.label_values(I.listing_pages(spark, sf_dir, "m"), rule)


# --- functions ---------------------------------------------------------------

@query(f"SELECT page_id, {URL_ID} AS id FROM pages")
def id_from_url(spark, sf_dir):
    pages = I.table(spark, sf_dir, "pages")
    return pages.select("page_id", text.id_from_url(c("url"), GIVEN_ID).alias("id"))


@query(r"""
SELECT page_id, TRY_CAST(replace(regexp_extract(replace(url, chr(160), ' '), '[\d\s]+'), ' ', '') AS BIGINT) AS number
FROM pages""")
def first_number(spark, sf_dir):
    pages = I.table(spark, sf_dir, "pages")
    return pages.select("page_id", text.first_number(c("url")).alias("number"))


@query(rf"""
SELECT page_id, {_clean(r"regexp_replace(html, '<[^>]*>', chr(10), 'g')")} AS text FROM pages""")
def clean_text(spark, sf_dir):
    pages = I.table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", text.clean_text(F.regexp_replace("html", "<[^>]*>", "\n")).alias("text")
    )


@query(f"SELECT page_id, nullif(array_to_string({LINK_TEXTS}, ' > '), '') AS trail FROM pages")
def list_to_text(spark, sf_dir):
    pages = I.table(spark, sf_dir, "pages")
    texts = F.filter(
        F.transform(html.element_texts(c("html"), "a"), text.clean_text), lambda t: t.isNotNull()
    )
    return pages.select(
        "page_id", bags.list_to_text(texts, V.BREADCRUMB_SEPARATOR).alias("trail")
    )
