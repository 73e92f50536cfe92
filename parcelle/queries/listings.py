"""Queries over listing-shaped inputs: parsing, clean-up, unified table, profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle import fixed_values as V
from parcelle.functions import bags, dates, places, text
from parcelle.operators import attributes, payloads, profiling, versions
from parcelle.plans import silver
from parcelle.queries import inputs as I
from parcelle.queries.registry import query
from parcelle.schemas import PAYLOAD_A, PAYLOAD_M, SILVER
from parcelle.sources import labels, latest

AS_OF = "1998-01-01 00:00:00"
FRESH_MINUTES = 500_000
#: Before it a table of newest rows was made, after it come the rows merged into it.
MERGED_AT = "1995-06-17 00:00:00"
LIST_MARK = " ## "

c = F.col


# --- checking SQL ------------------------------------------------------------

def _with(*names: str) -> str:
    parts = {
        "listing_a": I.LISTING_A,
        "listing_m": I.LISTING_M,
        "latest_a": _latest("listing_a"),
        "latest_m": _latest("listing_m"),
        "fresh_a": "SELECT * FROM listing_a WHERE ingest_ts >= "
                   f"TIMESTAMP '{AS_OF}' - INTERVAL '{FRESH_MINUTES}' MINUTE",
        "latest_fresh_a": _latest("fresh_a"),
        "early_a": f"SELECT * FROM listing_a WHERE ingest_ts < TIMESTAMP '{MERGED_AT}'",
        "late_a": f"SELECT * FROM listing_a WHERE ingest_ts >= TIMESTAMP '{MERGED_AT}'",
        "latest_early_a": _latest("early_a"),
        "latest_late_a": _latest("late_a"),
        "broken": I.BROKEN_LINES,
        "frame": I.KAFKA_FRAME,
        "sparse": I.SPARSE_FRAME,
        "event_rows": I.EVENT_ROWS,
        "relative": I.RELATIVE_DATES,
    }
    return "WITH " + ", ".join(f"{name} AS ({parts[name]})" for name in names) + " "


def _latest(source: str) -> str:
    return (
        "SELECT * EXCLUDE (age) FROM (SELECT *, row_number() OVER "
        # Of rows that are there again the text of the shorter title is the greater one.
        f"(PARTITION BY id ORDER BY ingest_ts DESC, title) AS age FROM {source}) WHERE age = 1"
    )


def _joined(items: str) -> str:
    return f"CASE WHEN len({items}) = 0 THEN '' ELSE array_to_string({items}, '{LIST_MARK}') END"


def _in(words: tuple[str, ...]) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def _seller(name: str, placeholders: tuple[str, ...]) -> str:
    return (
        f"CASE WHEN {name} IS NULL OR trim({name}) = '' OR lower(trim({name})) IN {_in(placeholders)} "
        f"THEN 'unknown' ELSE lower(trim({name})) END"
    )


def _object(column: str) -> str:
    """The text if it is a JSON object."""
    return f"CASE WHEN json_valid({column}) AND json_type({column}) = 'OBJECT' THEN {column} END"


def _value(column: str, label: str) -> str:
    key = label.replace("'", "''")
    return f"""json_extract_string({_object(column)}, '$."{key}"')"""


def _attribute(column: str, *spellings: str) -> str:
    """Of several spellings the first that is there; they are given in the order of their bytes."""
    return f"trim(coalesce({', '.join(_value(column, s) for s in spellings)}))"


PRICE = "TRY_CAST(regexp_replace(price_text, '[^0-9.]', '', 'g') AS DOUBLE)"
TRAIL = f"string_split(breadcrumbs, '{V.BREADCRUMB_SEPARATOR}')"
ANCHOR = f"nullif(list_position({TRAIL}, '{V.BREADCRUMB_ANCHOR}'), 0)"
CITY_A = f"trim({TRAIL}[{ANCHOR} + 1])"
AREA_A = (
    f"CASE WHEN trim({TRAIL}[{ANCHOR} + 2]) NOT IN {_in(V.NEIGHBORHOOD_PLACEHOLDERS)} "
    f"THEN trim({TRAIL}[{ANCHOR} + 2]) END"
)
PAIR = f"string_split(location_text, '{V.PLACE_SEPARATOR}')"
CITY_M = f"coalesce(trim({PAIR}[2]), trim({PAIR}[1]))"
AREA_M = f"trim({PAIR}[1])"
CATEGORY = r"string_split_regex(coalesce(category, ''), '\s*,\s*')"
PHRASE = f"trim({CATEGORY}[2])"
EXPECTED = (
    f"CASE WHEN {PHRASE} IN {_in(V.RENT_PHRASES)} THEN 'location' "
    f"WHEN {PHRASE} IN {_in(V.SALE_PHRASES)} THEN 'vente' END"
)
MATCH = f"coalesce({EXPECTED} = listing_type, false)"
IMAGES_A = (
    "list_filter(list_transform(string_split(image_urls, '|'), lambda x: trim(x)), lambda x: x <> '')"
)
EQUIPMENT_ITEMS = (
    "list_filter(list_transform(string_split(equipments, ';'), lambda x: trim(x)), lambda x: "
    "regexp_matches(x, '[A-Za-zÀ-ÿ]') AND NOT regexp_matches(x, '[0-9]') "
    "AND NOT contains(lower(x), 'moi') AND lower(x) NOT IN ('aucune', 'studio'))"
)
# list_distinct does not keep order: an item stays where it is met first.
EQUIPMENTS_A = (
    f"coalesce(list_filter({EQUIPMENT_ITEMS}, lambda x, i: list_position({EQUIPMENT_ITEMS}, x) = i), [])"
)
IMAGES_M = (
    "CASE WHEN json_valid(gallery_urls) AND json_type(gallery_urls) = 'ARRAY' "
    "THEN CAST(from_json(gallery_urls, '[\"VARCHAR\"]') AS VARCHAR[]) END"
)
# Columns and what is looked up for them, written out: the checks don't share how names are made.
ATTRIBUTES_A = {
    "surface_habitable": ["Surface habitable"], "caution": ["Caution"], "zoning": ["Zoning"],
    "type_d_appartement": ["Type d'appartement"], "standing": ["Standing"], "surface_totale": ["Surface totale"],
    "etage": ["Étage"], "age_du_bien": ["Âge du bien"], "nombre_de_pieces": ["Nombre de pièces"],
    "chambres": ["Chambres", "chambres"], "salle_de_bain": ["Salle de bain"],
    "frais_de_syndic_mois": ["Frais de syndic / mois"], "condition": ["Condition"],
    "nombre_d_etage": ["Nombre d'étage"], "disponibilite": ["Disponibilité"], "salons": ["Salons"],
}
ATTRIBUTES_M = {
    "type_de_bien": ["Type de bien", "type de bien"], "surface_de_la_parcelle": ["Surface de la parcelle"],
    "type_du_sol": ["Type du sol"], "etage_du_bien": ["Étage du bien"], "annees": ["Années"],
    "orientation": ["Orientation"], "etat": ["Etat", "etat"],
}
HAS_URL = "url IS NOT NULL AND trim(url) <> ''"


def _silver_sql(source: str, columns: dict[str, str]) -> str:
    types = {"images": "VARCHAR", "equipments": "VARCHAR", "price": "DOUBLE", "offre_match": "BOOLEAN"}
    picked = ", ".join(
        f"{columns[name]} AS {name}" if name in columns
        else f"CAST(NULL AS {types.get(name, 'VARCHAR')}) AS {name}"
        for name in SILVER.names
    )
    return f"SELECT {picked} FROM {source} WHERE {HAS_URL}"


SILVER_A_COLUMNS = {
    "id": "id", "url": "url", "error": "error", "ingest_ts": "ingest_ts", "site": f"'{V.SITE_A}'",
    "offre": "listing_type", "price": PRICE, "title": "title",
    "seller": _seller("seller_name", ("null", "none", "unknown")),
    "published_date": "published_date", "city": CITY_A, "neighborhood": AREA_A,
    "property_type": f"trim({CATEGORY}[1])", "images": _joined(IMAGES_A),
    "equipments": _joined(EQUIPMENTS_A), "description_text": "description", "offre_match": MATCH,
    **{name: _attribute("attributes", *spellings) for name, spellings in ATTRIBUTES_A.items()},
}
SILVER_M_COLUMNS = {
    "id": "id", "url": "url", "error": "error", "ingest_ts": "ingest_ts", "site": f"'{V.SITE_M}'",
    "offre": "listing_type", "price": "CASE WHEN price > 0 THEN price END", "title": "title",
    "seller": _seller("agency_name", ("nan", "null", "unknown")),
    "published_date": "published_date", "city": CITY_M, "neighborhood": AREA_M,
    "property_type": _value("features_main_json", "Type de bien"),
    "images": _joined(IMAGES_M), "description_text": "description_text",
    "features_amenities_json": "features_amenities_json",
    **{name: _attribute("features_main_json", *spellings) for name, spellings in ATTRIBUTES_M.items()},
}
SILVER_A_SQL = _silver_sql("latest_a", SILVER_A_COLUMNS)
SILVER_M_SQL = _silver_sql("latest_m", SILVER_M_COLUMNS)
SILVER_ALL = (
    _with("listing_a", "listing_m", "latest_a", "latest_m")
    + f", silver AS ({SILVER_A_SQL} UNION ALL {SILVER_M_SQL}) "
)


# --- helpers -----------------------------------------------------------------

def _a(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    return payloads.parse_payload(I.raw_a(spark, sf_dir), PAYLOAD_A, fields)


def _m(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    return payloads.parse_payload(I.raw_m(spark, sf_dir), PAYLOAD_M, fields)


def _all(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return silver.silver_all(I.raw_a(spark, sf_dir), I.raw_m(spark, sf_dir), columns=columns or None)


def _comparable(df: DataFrame) -> DataFrame:
    """Lists as joined text and times without zone, as the checking engine shows them."""
    shown = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.ArrayType):
            shown[field.name] = F.array_join(field.name, LIST_MARK)
        elif isinstance(field.dataType, T.TimestampType):
            shown[field.name] = c(field.name).cast("timestamp_ntz")
    return df.withColumns(shown)


# --- stream records and raw table --------------------------------------------

def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = I.derived(spark, sf_dir, I.KAFKA_FRAME, "events")
    return frame.select(
        F.encode("k", "UTF-8").alias("key"), F.encode("v", "UTF-8").alias("value"), "ts"
    )


@query(_with("frame") + "SELECT k, v, ts FROM frame")
def kafka_decode(spark, sf_dir):
    return payloads.decode_records(_records(spark, sf_dir), c("ts"))


@query(_with("frame") + """
SELECT coalesce(json_extract_string(v, '$.id'), k) AS id, v AS payload, ts AS ingest_ts FROM frame""")
def raw_envelope(spark, sf_dir):
    return payloads.raw_envelope(kafka_decode(spark, sf_dir))


@query(_with("event_rows") + """
SELECT id AS key,
 CAST(to_json({'id': id, 'title': title, 'attributes': attributes}) AS VARCHAR) AS value
FROM event_rows""")
def to_kafka_records(spark, sf_dir):
    rows = I.derived(spark, sf_dir, I.EVENT_ROWS, "events")
    return payloads.kafka_records(rows).select(
        c("key").cast("string").alias("key"), c("value").cast("string").alias("value")
    )


@query(_with("sparse") + """
SELECT concat(CASE WHEN k IS NULL OR k = '' THEN '-' ELSE k END, ' → ', coalesce(v, '')) AS line
FROM sparse""")
def stream_preview(spark, sf_dir):
    return payloads.preview_lines(I.derived(spark, sf_dir, I.SPARSE_FRAME, "events"))


@query(_with("listing_a") + "SELECT count(*) AS rows FROM listing_a")
def raw_scan_count(spark, sf_dir):
    return profiling.row_count(I.raw_a(spark, sf_dir))


@query(_with("listing_a") + """
SELECT count(*) AS rows, count(*) FILTER (WHERE length(title) % 3 = 0) AS malformed FROM listing_a""")
def malformed_count(spark, sf_dir):
    cut = F.when(F.length(F.get_json_object("payload", "$.title")) % 3 == 0, F.substring("payload", 1, 40)).otherwise(c("payload"))
    return profiling.malformed_rows(I.raw_a(spark, sf_dir).withColumn("payload", cut))


@query(_with("listing_a") + "SELECT * FROM listing_a")
def parse_payload_a(spark, sf_dir):
    return _comparable(_a(spark, sf_dir))


@query(_with("listing_m") + "SELECT * FROM listing_m")
def parse_payload_m(spark, sf_dir):
    return _comparable(_m(spark, sf_dir))


# --- versions ----------------------------------------------------------------

@query(_with("listing_a", "latest_a") + "SELECT id, title, ingest_ts FROM latest_a")
def latest_per_id(spark, sf_dir):
    keyed = payloads.key_by_document(I.raw_a(spark, sf_dir), PAYLOAD_A)
    newest = versions.latest_per_key(keyed)
    return _comparable(payloads.parse_payload(newest, PAYLOAD_A, ["id", "title"]))


@query(_with("listing_a", "early_a", "late_a", "latest_early_a", "latest_late_a") + f"""
SELECT id, url, title, ingest_ts FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingest_ts DESC) AS age
 FROM (SELECT * FROM latest_early_a WHERE {HAS_URL} UNION ALL SELECT * FROM latest_late_a WHERE {HAS_URL})) WHERE age = 1""")
def latest_merged(spark, sf_dir):
    raw, at = I.raw_a(spark, sf_dir), F.lit(MERGED_AT).cast("timestamp")
    there, rows = (latest.keyed(silver.silver_a(raw.where(kept))) for kept in (c("ingest_ts") < at, c("ingest_ts") >= at))
    found = latest.merged(there, latest.changed(there, rows))
    return _comparable(found.select("id", "url", "title", "ingest_ts"))


@query(_with("listing_a") + f"SELECT id, url, title FROM listing_a WHERE {HAS_URL}")
def valid_url(spark, sf_dir):
    return versions.valid_url(_a(spark, sf_dir, "id", "url", "title")).drop("ingest_ts")


@query(_with("listing_a", "fresh_a") + "SELECT id, title, ingest_ts FROM fresh_a")
def fresh_window(spark, sf_dir):
    fresh = versions.fresh_window(I.raw_a(spark, sf_dir), FRESH_MINUTES, F.lit(AS_OF).cast("timestamp"))
    return _comparable(payloads.parse_payload(fresh, PAYLOAD_A, ["id", "title"]))


# --- single columns, source A ------------------------------------------------

@query(_with("listing_a") + f"SELECT title, {PRICE} AS price FROM listing_a")
def clean_price_a(spark, sf_dir):
    return _a(spark, sf_dir, "title", "price_text").select(
        "title", text.price_from_text(c("price_text")).alias("price")
    )


@query(_with("listing_a") + f"SELECT title, CAST(CAST(round({PRICE}) AS BIGINT) AS VARCHAR) AS price FROM listing_a")
def format_price(spark, sf_dir):
    return _a(spark, sf_dir, "title", "price_text").select(
        "title", text.price_label(text.price_from_text(c("price_text"))).alias("price")
    )


@query(_with("listing_a") + f"""
SELECT count(*) FILTER (price_text IS NULL OR length(price_text) = 0) AS null_price_text,
 count(*) FILTER ({PRICE} IS NULL) AS null_price FROM listing_a""")
def price_quality(spark, sf_dir):
    return profiling.price_quality(_a(spark, sf_dir, "price_text"))


@query(_with("listing_a") + f"SELECT title, {SILVER_A_COLUMNS['seller']} AS seller FROM listing_a")
def clean_seller(spark, sf_dir):
    return _a(spark, sf_dir, "title", "seller_name").select(
        "title", text.seller_name(c("seller_name"), V.SELLER_PLACEHOLDERS_A).alias("seller")
    )


@query(_with("listing_m") + f"SELECT title, {SILVER_M_COLUMNS['seller']} AS seller FROM listing_m")
def clean_seller_m(spark, sf_dir):
    return _m(spark, sf_dir, "title", "agency_name").select(
        "title", text.seller_name(c("agency_name"), V.SELLER_PLACEHOLDERS_M).alias("seller")
    )


@query(_with("listing_a") + f"SELECT title, {CITY_A} AS city, {AREA_A} AS neighborhood FROM listing_a")
def geo_breadcrumbs(spark, sf_dir):
    placed = _a(spark, sf_dir, "title", "breadcrumbs").withColumn(
        "place", places.breadcrumb_place(c("breadcrumbs"))
    )
    return placed.select("title", "place.*")


@query(_with("listing_a") + f"SELECT title, trim({CATEGORY}[1]) AS property_type, {PHRASE} AS phrase FROM listing_a")
def category_split(spark, sf_dir):
    split = _a(spark, sf_dir, "title", "category").withColumn(
        "parts", places.category_parts(c("category"))
    )
    return split.select("title", "parts.*")


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrased = _a(spark, sf_dir, "title", "category", "listing_type").withColumn(
        "phrase", places.category_parts(c("category"))["phrase"]
    )
    return phrased.select(
        "title", "category", "phrase", c("listing_type").alias("offre"),
        places.offer_of_phrase(c("phrase")).alias("expected"),
        places.offer_matches(c("phrase"), c("listing_type")).alias("offre_match"),
    )


MATCHED_SQL = (
    f"SELECT title, category, {PHRASE} AS phrase, listing_type AS offre, {EXPECTED} AS expected, "
    f"{MATCH} AS offre_match FROM listing_a"
)


@query(_with("listing_a") + MATCHED_SQL)
def offer_match(spark, sf_dir):
    return _matched(spark, sf_dir)


@query(_with("listing_a") + MATCHED_SQL + f" WHERE NOT {MATCH}")
def offer_mismatch(spark, sf_dir):
    return profiling.offer_mismatch(_matched(spark, sf_dir))


@query(_with("listing_a") + f"SELECT title, {_joined(IMAGES_A)} AS images FROM listing_a")
def images_split(spark, sf_dir):
    return _comparable(_a(spark, sf_dir, "title", "image_urls").select(
        "title", bags.piped_images(c("image_urls")).alias("images")
    ))


@query(_with("listing_a") + f"SELECT title, {_joined(EQUIPMENTS_A)} AS equipments FROM listing_a")
def equipments_clean(spark, sf_dir):
    return _comparable(_a(spark, sf_dir, "title", "equipments").select(
        "title", bags.equipment_list(c("equipments")).alias("equipments")
    ))


# --- attribute bags ----------------------------------------------------------

def _bags_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _a(spark, sf_dir, "title", "attributes").select(
        "title", bags.attribute_map(c("attributes")).alias("bag")
    )


def _keys_sql(source: str, column: str) -> str:
    return f"SELECT DISTINCT unnest(json_keys({_object(column)})) AS k FROM {source}"


@query(_with("listing_a") + f"""
SELECT title, k, json_extract_string(attributes, concat('$."', k, '"')) AS v
FROM (SELECT title, attributes, unnest(json_keys({_object('attributes')})) AS k FROM listing_a)""")
def attr_map(spark, sf_dir):
    return _bags_a(spark, sf_dir).select("title", F.explode("bag").alias("k", "v"))


@query(_with("listing_a") + _keys_sql("listing_a", "attributes"))
def distinct_attr_keys(spark, sf_dir):
    return attributes.distinct_keys(_bags_a(spark, sf_dir), c("bag"))


@query(_with("listing_a") + f"""
SELECT k AS label, min(CAST(ingest_ts AS DATE)) AS first_day
FROM (SELECT unnest(json_keys({_object('attributes')})) AS k, ingest_ts FROM listing_a) GROUP BY k""")
def attr_labels(spark, sf_dir):
    return labels.labels_of(I.raw_a(spark, sf_dir), PAYLOAD_A, "attributes")


@query(_with("listing_a", "listing_m") + f"""
SELECT k, lower(trim(regexp_replace(strip_accents(k), '[^0-9a-zA-Z]+', '_', 'g'), '_')) AS name
FROM ({_keys_sql('listing_a', 'attributes')} UNION {_keys_sql('listing_m', 'features_main_json')})""")
def sanitize_keys(spark, sf_dir):
    keys_m = _m(spark, sf_dir, "features_main_json").select(
        F.explode(F.map_keys(bags.attribute_map(c("features_main_json")))).alias("k")
    )
    both = _bags_a(spark, sf_dir).select(F.explode(F.map_keys("bag")).alias("k")).union(keys_m)
    return attributes.sanitized_keys(both.distinct())


@query(_with("listing_a") + "SELECT title, " + ", ".join(
    f"{SILVER_A_COLUMNS[name]} AS {name}" for name in ATTRIBUTES_A) + " FROM listing_a")
def attr_columns(spark, sf_dir):
    texts = _a(spark, sf_dir, "title", "attributes")
    return attributes.labelled_attributes(texts, "attributes", V.LABELS_A).drop("attributes", "ingest_ts")


@query(_with("listing_a") + "SELECT title, " + ", ".join(
    f"{SILVER_A_COLUMNS[name]} AS {name}"
    for name in ("age_du_bien", "chambres", "etage", "surface_habitable")) + " FROM listing_a")
def attr_pivot(spark, sf_dir):
    names = ["age_du_bien", "chambres", "etage", "surface_habitable"]
    return attributes.pivoted_attributes(_bags_a(spark, sf_dir), c("bag"), names, ["title"])


# --- single columns, source M ------------------------------------------------

@query(_with("listing_m") + "SELECT title, CASE WHEN price > 0 THEN price END AS price FROM listing_m")
def clean_price_m(spark, sf_dir):
    return _m(spark, sf_dir, "title", "price").select(
        "title", text.positive_price(c("price")).alias("price")
    )


@query(_with("listing_m") + f"SELECT title, {CITY_M} AS city, {AREA_M} AS neighborhood FROM listing_m")
def geo_pair(spark, sf_dir):
    placed = _m(spark, sf_dir, "title", "location_text").withColumn(
        "place", places.paired_place(c("location_text"))
    )
    return placed.select("title", "place.*")


@query(_with("listing_m") + f"SELECT title, {_joined(IMAGES_M)} AS images FROM listing_m")
def images_json(spark, sf_dir):
    return _comparable(_m(spark, sf_dir, "title", "gallery_urls").select(
        "title", bags.json_list(c("gallery_urls")).alias("images")
    ))


@query(_with("listing_m") + f"SELECT title, {SILVER_M_COLUMNS['property_type']} AS property_type FROM listing_m")
def property_type_m(spark, sf_dir):
    return _m(spark, sf_dir, "title", "features_main_json").select(
        "title", bags.attribute_map(c("features_main_json"))[V.PROPERTY_TYPE_LABEL].alias("property_type")
    )


# --- functions over events ---------------------------------------------------

@query(_with("relative") + r"""
SELECT event_id, CASE WHEN rel IS NULL THEN NULL ELSE strftime(scrape_ts - to_seconds(
  coalesce(TRY_CAST(regexp_extract(rel, '\d+') AS BIGINT), 0) * CASE
   WHEN rel LIKE '%minute%' THEN 60 WHEN rel LIKE '%heure%' THEN 3600 WHEN rel LIKE '%jour%' THEN 86400
   WHEN rel LIKE '%semaine%' THEN 604800 WHEN rel LIKE '%mois%' THEN 2592000
   WHEN rel LIKE '%an%' THEN 31536000 ELSE 0 END), '%Y-%m-%d %H:%M:%S') END AS published_date
FROM relative""")
def relative_date(spark, sf_dir):
    events = I.derived(spark, sf_dir, I.RELATIVE_DATES, "events")
    return events.select(
        "event_id", dates.absolute_date(c("rel"), c("scrape_ts")).alias("published_date")
    )


@query(_with("relative") + """
SELECT event_id, CASE WHEN mode IN ('vendre', 'acheter') THEN 'vente' ELSE 'location' END AS offre FROM relative""")
def offer_type(spark, sf_dir):
    events = I.derived(spark, sf_dir, I.RELATIVE_DATES, "events")
    return events.select("event_id", places.offer_of_mode(c("mode")).alias("offre"))


# --- audits and profiles -----------------------------------------------------

@query(_with("listing_a") + """
SELECT id, concat('x', id) AS record_id FROM listing_a WHERE title LIKE '%7'""")
def id_mismatch(spark, sf_dir):
    raw = I.raw_of(I.listing_a(spark, sf_dir), "if(title LIKE '%7', concat('x', id), id)")
    return profiling.id_mismatch(payloads.parse_payload(raw, PAYLOAD_A, ["id"], keep=["record_id"]))


@query(_with("listing_a") + "SELECT id, count(*) AS count FROM listing_a GROUP BY id HAVING count(*) > 1")
def dup_ids(spark, sf_dir):
    return profiling.duplicate_ids(_a(spark, sf_dir, "id"))


@query(_with("listing_a") + """
SELECT count(*) AS rows FROM (SELECT id FROM listing_a GROUP BY id HAVING count(*) > 1)""")
def dup_id_total(spark, sf_dir):
    return profiling.row_count(profiling.duplicate_ids(_a(spark, sf_dir, "id")))


def _frequency(name: str, source: str, column: str, top: int | None = None) -> None:
    """A frequency query over one payload column of ``listing_a`` or ``listing_m``."""
    limit = f" ORDER BY count DESC, {column} NULLS FIRST LIMIT {top}" if top else ""
    check = f"SELECT {column}, count(*) AS count FROM {source} GROUP BY {column}{limit}"

    def run(spark, sf_dir):
        parsed = (_a if source == "listing_a" else _m)(spark, sf_dir, column)
        return profiling.value_counts(parsed, column, top=top)

    run.__name__ = name
    query(_with(source) + check)(run)


_frequency("freq_seller", "listing_a", "seller_name", top=10)
_frequency("freq_seller_type", "listing_a", "seller_type")
_frequency("freq_equipment_text", "listing_a", "equipments", top=5)
_frequency("freq_category", "listing_a", "category")
_frequency("freq_offer", "listing_a", "listing_type")
_frequency("freq_breadcrumbs", "listing_a", "breadcrumbs")
_frequency("freq_agency", "listing_m", "agency_name")
_frequency("freq_amenities", "listing_m", "features_amenities_json", top=10)
_frequency("freq_location", "listing_m", "location_text")
_frequency("freq_offer_m", "listing_m", "listing_type")


@query(_with("listing_a") + f"""
SELECT {_joined('equipments')} AS equipments, count FROM (
 SELECT {EQUIPMENTS_A} AS equipments, count(*) AS count FROM listing_a GROUP BY 1)""")
def freq_equipments(spark, sf_dir):
    lists = _a(spark, sf_dir, "equipments").select(
        bags.equipment_list(c("equipments")).alias("equipments")
    )
    return _comparable(profiling.value_counts(lists, "equipments"))


@query(_with("listing_a") + f"SELECT DISTINCT {_joined(IMAGES_A)} AS images FROM listing_a")
def distinct_images(spark, sf_dir):
    lists = _a(spark, sf_dir, "image_urls").select(bags.piped_images(c("image_urls")).alias("images"))
    return _comparable(lists.distinct())


@query(_with("listing_m") + "SELECT DISTINCT price FROM listing_m")
def distinct_price_m(spark, sf_dir):
    return _m(spark, sf_dir, "price").select("price").distinct()


@query(_with("listing_a", "broken") + r"""
SELECT id, regexp_replace(title, '[\r\n\t]+', ' ', 'g') AS title,
 regexp_replace(description, '[\r\n\t]+', ' ', 'g') AS description, ingest_ts
FROM broken ORDER BY ingest_ts, id LIMIT 10""")
def preview_clean(spark, sf_dir):
    broken = I.over(I.listing_a(spark, sf_dir), I.BROKEN_LINES, "listing_a")
    return profiling.preview(broken, 10, "ingest_ts", "id")


# --- unified table -----------------------------------------------------------

@query(_with("listing_a", "latest_a") + SILVER_A_SQL)
def silver_a(spark, sf_dir):
    return _comparable(silver.silver_a(I.raw_a(spark, sf_dir)))


@query(_with("listing_m", "latest_m") + SILVER_M_SQL)
def silver_m(spark, sf_dir):
    return _comparable(silver.silver_m(I.raw_m(spark, sf_dir)))


@query(_with("listing_a", "fresh_a", "latest_fresh_a") + _silver_sql("latest_fresh_a", SILVER_A_COLUMNS))
def silver_a_fresh(spark, sf_dir):
    return _comparable(silver.silver_a(I.raw_a(spark, sf_dir), FRESH_MINUTES, F.lit(AS_OF).cast("timestamp")))


@query(SILVER_ALL + "SELECT * FROM silver")
def silver_all(spark, sf_dir):
    return _comparable(_all(spark, sf_dir))


@query(SILVER_ALL + "SELECT site, id, TRY_CAST(published_date AS TIMESTAMP) AS published_at FROM silver")
def published_time(spark, sf_dir):
    rows = _all(spark, sf_dir, "site", "id", "published_date")
    return _comparable(rows.select("site", "id", dates.published_time(c("published_date")).alias("published_at")))


@query(SILVER_ALL + "SELECT id, title, price, city, offre FROM silver ORDER BY site, id LIMIT 5")
def silver_sample(spark, sf_dir):
    return _all(spark, sf_dir, "site", "id", "title", "price", "city", "offre").orderBy("site", "id").limit(5).select(
        "id", "title", "price", "city", "offre"
    )


@query(SILVER_ALL + "SELECT city, offre, count(*) AS count FROM silver GROUP BY city, offre")
def count_city_offer(spark, sf_dir):
    return profiling.group_counts(_all(spark, sf_dir, "city", "offre"), "city", "offre")


@query(SILVER_ALL + "SELECT offre, round(avg(price), 2) AS avg_price FROM silver GROUP BY offre")
def avg_price_offer(spark, sf_dir):
    means = profiling.mean_by(_all(spark, sf_dir, "offre", "price"), "offre", "price", "avg_price")
    return means.withColumn("avg_price", F.round("avg_price", 2))
