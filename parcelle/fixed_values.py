"""Names, word lists, patterns and formats that results depend on.

Everything here is data that has to be exactly as it is for rows to come out
right; the logic that uses it lives in the other modules.
"""

# --- sources -----------------------------------------------------------------
SITE_A = "avito"
SITE_M = "mubawab"
SITES = (SITE_A, SITE_M)

TOPICS = {
    SITE_A: "realestate.avito.raw",
    SITE_M: "realestate.mubawab.raw",
}
RAW_NAMESPACE = "raw"
SILVER_NAMESPACE = "silver"
SILVER_TABLE = "listings_all"
#: This library's own: the newest rows of the unified table.
LATEST_TABLE = "listings_latest"
#: The labels of attributes that were met.
LABEL_TABLE = "attribute_labels"

# --- payload fields ----------------------------------------------------------
PAYLOAD_A = (
    "id", "url", "error", "title", "price_text", "breadcrumbs", "category",
    "description", "attributes", "equipments", "seller_name", "seller_type",
    "published_date", "image_urls", "listing_type",
)
PAYLOAD_M = (
    "id", "url", "error", "listing_type", "title", "price", "location_text",
    "features_amenities_json", "description_text", "features_main_json",
    "gallery_urls", "agency_name", "agency_url", "published_date",
)

# --- unified table: columns in contractual order -----------------------------
SILVER_COLUMNS = (
    "id", "url", "error", "ingest_ts", "site", "offre", "price", "title", "seller",
    "published_date", "city", "neighborhood", "property_type", "images", "equipments",
    "description_text", "offre_match", "surface_habitable", "caution", "zoning",
    "type_d_appartement", "standing", "surface_totale", "etage", "age_du_bien",
    "nombre_de_pieces", "chambres", "salle_de_bain", "frais_de_syndic_mois",
    "condition", "nombre_d_etage", "disponibilite", "salons",
    "features_amenities_json", "type_de_bien", "surface_de_la_parcelle",
    "type_du_sol", "etage_du_bien", "annees", "orientation", "etat",
)

# --- attribute labels that become columns ------------------------------------
LABELS_A = (
    "Surface habitable", "Caution", "Zoning", "Type d'appartement", "Standing",
    "Surface totale", "Étage", "Âge du bien", "Nombre de pièces", "Chambres",
    "Salle de bain", "Frais de syndic / mois", "Condition", "Nombre d'étage",
    "Disponibilité", "Salons",
)
LABELS_M = (
    "Type de bien", "Surface de la parcelle", "Type du sol", "Étage du bien",
    "Années", "Orientation", "Etat",
)
PROPERTY_TYPE_LABEL = "Type de bien"

# --- sellers -----------------------------------------------------------------
UNKNOWN_SELLER = "unknown"
SELLER_PLACEHOLDERS_A = ("null", "none", "unknown")
SELLER_PLACEHOLDERS_M = ("nan", "null", "unknown")
SHOP_SELLER = "Boutique"
PRIVATE_SELLER = "Particulier"

# --- places ------------------------------------------------------------------
BREADCRUMB_SEPARATOR = " > "
BREADCRUMB_ANCHOR = "Tout le Maroc"
NEIGHBORHOOD_PLACEHOLDERS = (
    "Avito Immobilier", "أفيتو للعقار", "Toute la ville", "Autre secteur",
)
PLACE_SEPARATOR = " à "

# --- offers ------------------------------------------------------------------
SALE = "vente"
RENT = "location"
SALE_MODES = ("vendre", "acheter")
RENT_PHRASES = ("à louer", "a louer")
SALE_PHRASES = ("à vendre", "a vendre")

# --- lists inside text fields ------------------------------------------------
IMAGE_SEPARATOR = " | "
EQUIPMENT_SEPARATOR = "; "
EQUIPMENT_NEEDS = "[A-Za-zÀ-ÿ]"
EQUIPMENT_BARS = "[0-9]"
EQUIPMENT_BARRED_PART = "moi"
EQUIPMENT_BARRED_WORDS = ("aucune", "studio")

# --- relative dates: tested in this order, seconds per unit -------------------
DATE_UNITS = (
    ("minute", 60),
    ("heure", 3600),
    ("jour", 86400),
    ("semaine", 7 * 86400),
    ("mois", 30 * 86400),
    ("an", 365 * 86400),
)
DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"

# --- page addresses ----------------------------------------------------------
BASE_URL_A = "https://www.avito.ma"
BASE_URL_M = "https://www.mubawab.ma"
ID_PATTERN_A = r"_(\d+)\.htm"
ID_PATTERN_M = r"/a/(\d+)/"
IMAGE_HOST_A = "content.avito.ma"
IMAGE_HOST_M = "mubawab-media.com/ad/"
LINK_PARTS_A = ("_", ".htm")
LINK_PART_M = "/fr/a/"
LINKS_PER_PAGE_M = 25

# --- where the fields are on a page (CSS selectors) ---------------------------
LINK_SELECTORS_A = (
    "a.sc-1jge648-0[href]",
    "section.sc-b341c660-0 a[href]",
)
SELECTORS_A = {
    "title": "h1.sc-9ca53b09-5",
    "price_text": "p.sc-9ca53b09-10",
    "breadcrumbs": "ol.sc-16q833i-0 a, ol.sc-16q833i-0 span.sc-16q833i-2",
    "category": "div.sc-172bdcdc-0 span.sc-1x0vz2r-0.fjZBup",
    "description": "div.sc-7378144c-0",
    "attribute": "div.sc-cd1c365e-1.clDxnX",
    "attribute_icon": "img[alt]",
    "attribute_label": "span.sc-1x0vz2r-0.bXFCIH",
    "attribute_value": "span.sc-1x0vz2r-0.fjZBup",
    "equipment": "div.sc-cd1c365e-0.bERAxq div.sc-cd1c365e-1",
    "equipment_name": "span.sc-1x0vz2r-0.fjZBup",
    "seller_name": "p.sc-1l0do2b-9",
    "shop_badge": 'svg[aria-labelledby*="ShopBadge"]',
    "published": "time",
    "images": "div.slick-slide img[src]",
}
LINK_SELECTORS_M = (
    "div.listingBox[linkref]",
    "h2.listingTit a[href]",
    'a[href*="/fr/a/"]',
)
SELECTORS_M = {
    "title": "h1.searchTitle",
    "price": "h3.orangeTit",
    "location": "h3.greyTit",
    "amenities": "div.adFeatures div.adFeature span",
    "description_block": "div.blockProp",
    "description": "p",
    "feature": "div.caractBlockProp div.adMainFeature",
    "feature_label": "p.adMainFeatureContentLabel",
    "feature_value": "p.adMainFeatureContentValue",
    "gallery": "div.picturesGallery img[src]",
    "slider": "div.flipsnap img[src]",
    "agency": "div.businessInfo",
    "agency_name": "span.businessName",
    "agency_link": "a[href]",
}

# --- job defaults ------------------------------------------------------------
WINDOW_MINUTES = 35
TRIGGER = "15 seconds"
PRODUCER_OPTIONS = {
    "kafka.enable.idempotence": "true",
    "kafka.acks": "all",
    "kafka.compression.type": "lz4",
    "kafka.linger.ms": "20",
}

# --- tables ------------------------------------------------------------------

APPEND = "append"
OVERWRITE_MODES = ("overwrite", "dynamic_overwrite", "dynamic-overwrite")
ICEBERG_TABLE = {"format-version": "2", "write.distribution-mode": "none"}
ICEBERG_WRITE = {"check-nullability": "false", "check-ordering": "false"}
