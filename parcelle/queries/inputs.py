"""Listing-shaped inputs derived from the given tables.

The same SQL text runs in Spark and in the checking engine. The Spark queries pack
the columns into a JSON payload and run the library on it; the checking SQL starts
from the plain columns, so it shares nothing with the code under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The seconds added to the date tell versions of one id apart, but for some rows that are there
# again with a longer title. Some ids occur once, and every label and spelling somewhere.
LISTING_A = """
SELECT
 CASE WHEN o_orderkey % 5 = 0 THEN concat('u', CAST(o_orderkey AS VARCHAR(20))) ELSE CAST(o_orderkey % 4000 AS VARCHAR(20)) END AS id,
 CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN '  '
      ELSE concat('https://example.test/fr/x_', CAST(o_orderkey % 4000 AS VARCHAR(20)), '.htm') END AS url,
 CASE o_orderkey % 29 WHEN 0 THEN 'page has no text' END AS error,
 concat('Annonce ', CAST(o_orderkey AS VARCHAR(20)), again) AS title,
 CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Prix sur demande'
      ELSE concat(CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR(20)), ' ',
                  lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS VARCHAR(20)), 3, '0'), ' DH') END AS price_text,
 CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Accueil > Rabat' WHEN 2 THEN 'Tout le Maroc > Rabat'
      WHEN 3 THEN 'Accueil > Tout le Maroc > Rabat > Toute la ville > X'
      ELSE 'Accueil > Tout le Maroc > Casa > Agdal > Appartements' END AS breadcrumbs,
 CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Appartements , à louer' WHEN 2 THEN 'Villas,à vendre' ELSE 'Terrains' END AS category,
 concat('Texte ', o_orderpriority) AS description,
 CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '{"Surface habitable":" 90 m2 ","Étage":"3"}'
      WHEN 2 THEN '{"chambres":"7","Salons":"1"}' WHEN 3 THEN '{"chambres":"7","Chambres":"4"}'
      WHEN 4 THEN 'no object' WHEN 5 THEN '{"Caution":"2 mois","Zoning":"R+4","Type d''appartement":"T3","Standing":" haut",
        "Surface totale":"120","Nombre de pièces":"5","Salle de bain":"2","Frais de syndic / mois":"300","Condition":"bon",
        "Nombre d''étage":"4","Disponibilité":"oui","Salons":"2"}'
      WHEN 6 THEN '{}' ELSE '{"Chambres":"2","Âge du bien":"1-5 ans"}' END AS attributes,
 CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Ascenseurs; Balcon ; 2 ; 1 mois; Studio; Balcon' ELSE 'Parking;sauna ;; Jardin' END AS equipments,
 CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN ' None '
      ELSE concat(' Agence ', CAST(o_custkey % 20 AS VARCHAR(20)), ' ') END AS seller_name,
 CASE o_orderkey % 2 WHEN 0 THEN 'Boutique' ELSE 'Particulier' END AS seller_type,
 '2025-11-02 10:00:00' AS published_date,
 CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'a | b|c' ELSE ' | z | ' END AS image_urls,
 CASE WHEN o_orderkey % 6 < 3 THEN 'location' ELSE 'vente' END AS listing_type,
 o_orderdate + CAST(o_orderkey % 2000000000 AS INT) * INTERVAL '1' SECOND AS ingest_ts
FROM (SELECT *, '' AS again FROM orders UNION ALL SELECT *, ' b' AS again FROM orders WHERE o_orderkey % 31 = 0) AS versions
"""

LISTING_M = """
SELECT
 concat('m', CAST(CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey ELSE o_orderkey % 3000 END AS VARCHAR(20))) AS id,
 CASE WHEN o_orderkey % 23 = 0 THEN NULL
      ELSE concat('https://example.test/fr/a/', CAST(o_orderkey % 3000 AS VARCHAR(20)), '/x') END AS url,
 CASE o_orderkey % 37 WHEN 0 THEN 'page has no text' END AS error,
 CASE o_orderkey % 2 WHEN 0 THEN 'vente' ELSE 'location' END AS listing_type,
 concat('Bien ', CAST(o_orderkey AS VARCHAR(20))) AS title,
 CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN CAST(0 AS DOUBLE) WHEN 2 THEN CAST(-1 AS DOUBLE) ELSE o_totalprice END AS price,
 CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Rabat' WHEN 2 THEN 'Agdal à Rabat' ELSE 'Hay à Salam à Fès' END AS location_text,
 CASE o_orderkey % 2 WHEN 0 THEN NULL ELSE '["Terrasse","Ascenseur"]' END AS features_amenities_json,
 concat('Texte ', o_orderpriority) AS description_text,
 CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '{"Type de bien":" Villa ","Étage du bien":"2"}'
      WHEN 2 THEN '{"Surface de la parcelle":"400","Type du sol":"marbre","Années":"5-10","Orientation":" Sud"}'
      WHEN 3 THEN '[1]' WHEN 4 THEN '{"etat":"ancien","type de bien":"x"}'
      ELSE '{"Type de bien":"Appartement","Etat":" Neuf "}' END AS features_main_json,
 CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '["a","b"]' WHEN 2 THEN '{"a":"b"}' ELSE '[]' END AS gallery_urls,
 CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'NaN' WHEN 2 THEN ' ' ELSE ' Agence X' END AS agency_name,
 'https://example.test/agence' AS agency_url,
 CASE o_orderkey % 11 WHEN 0 THEN '2025-11-02 10:00:00' END AS published_date,
 o_orderdate + CAST(o_orderkey % 2000000000 AS INT) * INTERVAL '1' SECOND AS ingest_ts
FROM orders
"""

KAFKA_FRAME = """
SELECT
 CAST(user_id AS VARCHAR(20)) AS k,
 CASE event_id % 3 WHEN 0 THEN concat('{"id":"', CAST(event_id AS VARCHAR(20)), '","v":1}')
      WHEN 1 THEN '{"id":null,"v":1}' ELSE '{"v":1}' END AS v,
 ts
FROM events
"""

SPARSE_FRAME = """
SELECT
 CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CAST(user_id AS VARCHAR(20)) END AS k,
 CASE event_id % 5 WHEN 0 THEN NULL ELSE props END AS v
FROM events
"""

EVENT_ROWS = """
SELECT
 CAST(event_id AS VARCHAR(20)) AS id,
 CASE event_type WHEN 'click' THEN NULL ELSE concat(event_type, ' à é "x"') END AS title,
 props AS attributes
FROM events
"""

RELATIVE_DATES = """
SELECT event_id,
 CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN 'à l''instant' WHEN 2 THEN 'il y a 5 minutes' WHEN 3 THEN 'il y a 3 heures'
      WHEN 4 THEN 'il y a 2 jours' WHEN 5 THEN 'il y a 1 semaine' WHEN 6 THEN 'il y a 4 mois' WHEN 7 THEN 'il y a 2 ans'
      ELSE 'il y a 7 lunes' END AS rel,
 CASE event_id % 4 WHEN 0 THEN 'vendre' WHEN 1 THEN 'acheter' WHEN 2 THEN 'louer' ELSE NULL END AS mode,
 ts AS scrape_ts
FROM events
"""

BROKEN_LINES = """
SELECT id, replace(title, ' ', concat(chr(13), chr(10))) AS title,
 concat('a', chr(9), chr(9), description, chr(10)) AS description, ingest_ts
FROM listing_a
"""

# The given pages hold links but no pictures: each link becomes one.
PICTURE_PAGES = """
SELECT page_id, url,
 replace(replace(html, '<a href="/', '<img class="x" src="https://cdn.example.test/'),
         'cdn.example.test/t', 'other.example.test/t') AS html
FROM pages
"""

# Some of the links of the given pages become addresses of listings.
LISTED_PAGES = """
SELECT page_id, url,
 replace(replace(html, '<a href="/d', '<a href="/fr/casa/d_12.htm?d'), '<a href="/th', '<a href="/fr/rabat/th_7.htm?th') AS html
FROM pages
"""

# What listing pages of source A say, one page for each order; the checks start from these columns.
PAGE_ROWS_A = """
SELECT o_orderkey AS page_id, concat('https://www.avito.ma/fr/x_', CAST(o_orderkey AS VARCHAR(20)), '.htm') AS url,
 concat('Bien ', CAST(o_orderkey AS VARCHAR(20)), ' & fils') AS title,
 CASE o_orderkey % 5 WHEN 0 THEN NULL ELSE concat(CAST(o_orderkey % 900 AS VARCHAR(20)), ' 000 DH') END AS price,
 CASE o_orderkey % 4 WHEN 0 THEN NULL ELSE 'Appartements, à louer' END AS category,
 CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '3' ELSE '12' END AS rooms,
 CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'il y a 2 jours' WHEN 2 THEN 'il y a 9000 ans' ELSE 'à l''instant' END AS age,
 CASE o_orderkey % 8 WHEN 0 THEN NULL ELSE concat('https://content.avito.ma/', CAST(o_orderkey % 50 AS VARCHAR(20)), '.jpg') END AS picture,
 o_orderkey % 2 AS shop, o_orderkey % 11 AS nothing, o_orderpriority AS said
FROM orders
"""

HTML_A = """
SELECT page_id, url, CASE WHEN nothing <> 0 THEN concat(
 '<html><body><ol class="x sc-16q833i-0"><li><a href="/">Accueil</a></li><li><span class="sc-16q833i-2">Tout le Maroc </span></li></ol>',
 '<h1 class="sc-9ca53b09-5 y">', replace(title, '&', '&amp;'), '</h1>',
 coalesce(concat('<p class="sc-9ca53b09-10">', price, '</p>'), ''),
 coalesce(concat('<div class="sc-172bdcdc-0"><span class="sc-1x0vz2r-0 fjZBup">', category, '</span></div>'), ''),
 '<div class="sc-7378144c-0">', said, '<br>Fin</div>',
 coalesce(concat('<div class="sc-cd1c365e-1 clDxnX"><img alt="i"><span class="sc-1x0vz2r-0 fjZBup">', rooms,
  '</span><span class="sc-1x0vz2r-0 bXFCIH">Chambres</span></div>'), ''),
 '<div class="sc-cd1c365e-1 clDxnX"><img alt="i"><span class="sc-1x0vz2r-0 bXFCIH">Salons</span></div>',
 '<div class="sc-cd1c365e-0 bERAxq"><div class="sc-cd1c365e-1"><span class="sc-1x0vz2r-0 fjZBup">Parking</span></div></div>',
 '<p class="sc-1l0do2b-9">Agence ', said, '</p>', CASE shop WHEN 1 THEN '<svg aria-labelledby="ShopBadgeTitle"></svg>' ELSE '' END,
 coalesce(concat('<div>', age, ' <time></time></div>'), ''),
 coalesce(concat('<div class="slick-slide"><img src="', picture, '"><img src="https://other.test/x.jpg"><img src="', picture, '"></div>'), ''),
 '</body></html>') END AS html
FROM rows_a
"""

PAGE_ROWS_M = """
SELECT o_orderkey AS page_id, concat('https://www.mubawab.ma/fr/a/', CAST(o_orderkey AS VARCHAR(20)), '/x') AS url,
 concat('Villa ', CAST(o_orderkey AS VARCHAR(20))) AS title,
 CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN -1 ELSE o_orderkey % 900 END AS thousands,
 CASE o_orderkey % 4 WHEN 0 THEN NULL ELSE 'Agdal à Rabat' END AS place,
 CASE o_orderkey % 3 WHEN 0 THEN NULL ELSE 'Terrasse' END AS amenity,
 CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Riad' ELSE 'Villa' END AS kind,
 CASE o_orderkey % 7 WHEN 0 THEN NULL ELSE concat('https://x.mubawab-media.com/ad/', CAST(o_orderkey % 50 AS VARCHAR(20)), '.jpg') END AS picture,
 CASE o_orderkey % 9 WHEN 0 THEN NULL ELSE o_orderpriority END AS agency, o_orderkey % 11 AS nothing
FROM orders
"""

HTML_M = """
SELECT page_id, url, CASE WHEN nothing <> 0 THEN concat(
 '<h1 class="searchTitle">', title, '</h1>',
 coalesce(concat('<h3 class="orangeTit">', CASE WHEN thousands < 0 THEN 'Prix sur demande' ELSE concat(CAST(thousands AS STRING), ' 000 DH') END, '</h3>'), ''),
 coalesce(concat('<h3 class="greyTit">', place, '</h3>'), ''),
 '<div class="adFeatures"><div class="adFeature"><span>Jardin</span></div>', coalesce(concat('<div class="adFeature"><span>', amenity, '</span></div>'), ''), '</div>',
 '<div class="blockProp"><p>Belle vue<p>Suite</div>',
 coalesce(concat('<div class="caractBlockProp"><div class="adMainFeature"><p class="adMainFeatureContentLabel">Type de bien</p>',
  '<p class="adMainFeatureContentValue">', kind, '</p></div></div>'), ''),
 coalesce(concat('<div class="picturesGallery"><img src="', picture, '"><img src="/logo.png"></div><div class="flipsnap"><img src="', picture, '"></div>'), ''),
 coalesce(concat('<div class="businessInfo"><span class="businessName"> ', agency, '</span><a href="/fr/agence/1">x</a></div>'), '')) END AS html
FROM rows_m
"""

# Pages of results: links of either tier, one of them twice, and links to something else.
RESULTS_A = """
SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 13 <> 0 THEN concat(
 '<a href="/fr/help">Aide</a><a class="z sc-1jge648-0" href="/fr/b_', CAST(o_orderkey AS STRING), '.htm">b</a>',
 '<section class="sc-b341c660-0"><a href="./fr/c_', CAST(o_orderkey % 100 AS STRING), '.htm">c</a>',
 '<p><a href=''/fr/b_', CAST(o_orderkey AS STRING), '.htm''>b</a><a href="/fr/no.htm">n</a></p></section>',
 '<a class="sc-1jge648-0" href=https://www.avito.ma/fr/d_', CAST(o_orderkey % 10 AS STRING), '.htm>d</a>') END AS html
FROM orders
"""

RESULTS_M = """
SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 13 <> 0 THEN concat(
 '<div class="listingBox" linkref="https://www.mubawab.ma/fr/a/', CAST(o_orderkey AS STRING), '/b">b</div>',
 '<h2 class="listingTit"><a href="/fr/a/', CAST(o_orderkey % 100 AS STRING), '/c">c</a></h2><h2 class="listingTit"><a href="/fr/p/1">p</a></h2>',
 '<a href="/fr/a/', CAST(o_orderkey % 10 AS STRING), '/d">d</a><a href="/fr/help">Aide</a>') END AS html
FROM orders
"""

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, text: str, source: str) -> DataFrame:
    """The rows of an input text over one given table."""
    return over(table(spark, sf_dir, source), text, source)


def over(df: DataFrame, text: str, name: str) -> DataFrame:
    """The rows of an SQL text that reads ``df`` under a name; leaves no view behind."""
    literal = text.replace("{", "{{").replace("}", "}}")
    named = literal.replace(f"FROM {name}", "FROM {source}")
    return df.sparkSession.sql(named, source=df)


def dealt(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A given table over all cores: pages made of its rows are a hundred times as long, but its file is one split."""
    return table(spark, sf_dir, name).repartition(spark.sparkContext.defaultParallelism, key)


def listing_pages(spark: SparkSession, sf_dir: str, site: str) -> DataFrame:
    """Listing pages (page_id, url, html) of source A or M, one for each order."""
    said, page, name = (PAGE_ROWS_A, HTML_A, "rows_a") if site == "a" else (PAGE_ROWS_M, HTML_M, "rows_m")
    return over(over(dealt(spark, sf_dir, "orders", "o_orderkey"), said, "orders"), page, name)


def result_pages(spark: SparkSession, sf_dir: str, site: str) -> DataFrame:
    """Pages of results (page_id, html) of source A or M, one for each order."""
    return over(dealt(spark, sf_dir, "orders", "o_orderkey"), RESULTS_A if site == "a" else RESULTS_M, "orders")


def listing_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, LISTING_A, "orders")


def listing_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, LISTING_M, "orders")


def raw_of(listings: DataFrame, envelope_id: str = "id") -> DataFrame:
    """Listings as RAW envelopes, with the payload as JSON text that keeps its NULLs."""
    fields = [name for name in listings.columns if name != "ingest_ts"]
    return listings.select(
        F.expr(envelope_id).alias("id"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("payload"),
        F.col("ingest_ts").cast("timestamp").alias("ingest_ts"),
    )


def raw_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_of(listing_a(spark, sf_dir))


def raw_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_of(listing_m(spark, sf_dir))
