"""Column functions on single values."""

import datetime as dt
import re
import unicodedata
from html import unescape
from urllib.parse import urljoin

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelle import fixed_values as V
from parcelle.functions import bags, dates, html, places, text
from parcelle.operators import page_rules

NOW = dt.datetime(2025, 11, 2, 10, 0, 0)


def each(spark, function, values, schema="v string"):
    """function applied to a column of values, as a list of results."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in rows.orderBy("i").select(function(F.col("v"))).collect()]


def test_price_from_text(spark):
    values = ["1 200 000 DH", "1 200 000 DH", "12,500 DH", "Prix sur demande", "1.200.000", "", None, "."]
    assert each(spark, text.price_from_text, values) == [
        1200000.0, 1200000.0, 12500.0, None, None, None, None, None,
    ]


def test_positive_price(spark):
    values = [0.0, -1.0, None, 850000.0]
    assert each(spark, text.positive_price, values, "v double") == [None, None, None, 850000.0]


def test_price_label(spark):
    values = [1200000.0, 12500.5, None, 1e12, float("nan"), 1e39]
    assert each(spark, text.price_label, values, "v double") == [
        "1200000", "12501", None, "1000000000000", None, None,
    ]


def test_first_number(spark):
    values = [
        "850 000 DH", "850 000 DH", "Prix 850 000", "A partir de 850 000", "à consulter",
        None, "", "8\t5 0", "٨٥٠ DH", "12 34.5",
    ]
    assert each(spark, text.first_number, values) == [
        850000, 850000, 850000, None, None, None, None, None, 850, 1234,
    ]


@pytest.mark.parametrize("placeholders, values, expected", [
    (V.SELLER_PLACEHOLDERS_A, ["NONE", " Agence X ", "nan", None, "", "  ", "Unknown", "null"],
     ["unknown", "agence x", "nan", "unknown", "unknown", "unknown", "unknown", "unknown"]),
    (V.SELLER_PLACEHOLDERS_M, ["NaN", "none", " NULL"], ["unknown", "none", "unknown"]),
])
def test_seller_name(spark, placeholders, values, expected):
    assert each(spark, lambda v: text.seller_name(v, placeholders), values) == expected


def test_seller_keeps_no_break_space(spark):
    assert each(spark, lambda v: text.seller_name(v, ()), [" X"]) == [" x"]


def test_clean_text(spark):
    values = [" a\r\n\tb  c ", " x y　", "\x1c z", " \n", "", None]
    assert each(spark, text.clean_text, values) == ["a b c", "x y", "z", None, None, None]
    assert each(spark, text.collapse_blanks, [" \n", None]) == ["", None]


@settings(max_examples=30, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=20), min_size=20, max_size=60))
def test_clean_text_is_python_whitespace(spark, values):
    values = [v for v in values if not _lone_surrogate(v) and "\0" not in v]
    assert each(spark, text.clean_text, values) == [" ".join(v.split()) or None for v in values]


def test_id_from_url(spark):
    assert each(spark, lambda u: text.id_from_url(u, V.ID_PATTERN_A), ["/fr/x_123.htm", "/fr/x.htm", None]) == [
        "123", None, None,
    ]
    assert each(spark, lambda u: text.id_from_url(u, V.ID_PATTERN_M), ["/fr/a/77/x", "/fr/a/x/"]) == ["77", None]


def test_absolute_url(spark):
    base = "https://site.test"
    values = ["/fr/a", "x_1.htm", "http://o.test/y", "//cdn.test/z", "mailto:a@b", "?p=2", "#top", ""]
    assert each(spark, lambda u: text.absolute_url(u, base), values) == [
        base + "/fr/a", base + "/x_1.htm", "http://o.test/y", "https://cdn.test/z", "mailto:a@b",
        base + "?p=2", base + "#top", base,
    ]


def test_column_name(spark):
    cases = {
        "Étage du bien": "etage_du_bien",
        "Frais de syndic / mois": "frais_de_syndic_mois",
        "Type d'appartement": "type_d_appartement",
        "Type d’appartement": "type_dappartement",
        "Surface m²": "surface_m2",
        "المساحة": "",
        "½ étage ﬁn": "12_etage_fin",
        "__A--b__": "a_b",
    }
    assert each(spark, text.column_name, cases) == list(cases.values())
    for label in V.LABELS_A + V.LABELS_M:
        assert each(spark, text.column_name, [label]) == [text.label_to_column(label)]


def _lone_surrogate(value):
    return any(0xD800 <= ord(c) <= 0xDFFF for c in value)


LATIN = st.text(st.characters(min_codepoint=0x20, max_codepoint=0x24F), max_size=12)


@settings(max_examples=30, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(LATIN, st.text(max_size=12)), min_size=20, max_size=80))
def test_folding_is_compatibility_decomposition(spark, values):
    values = [v for v in values if not _lone_surrogate(v)]
    folded = [unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode() for v in values]
    assert each(spark, text.ascii_fold, values) == folded
    named = [re.sub("[^0-9a-zA-Z]+", "_", f).strip("_").lower() for f in folded]
    assert each(spark, text.column_name, values) == named


def test_folding_of_every_decomposable_character(spark):
    source, _, longer = text._fold_tables()
    values = [*source, *longer]
    folded = [unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode() for v in values]
    assert each(spark, text.ascii_fold, values) == folded


@pytest.mark.parametrize("given_text, expected", [
    ("il y a 3 mois", "2025-08-04 10:00:00"),
    ("Il y a 5 MINUTES ", "2025-11-02 09:55:00"),
    ("il y a 3 heures", "2025-11-02 07:00:00"),
    ("il y a 2 jours", "2025-10-31 10:00:00"),
    ("il y a 1 semaine", "2025-10-26 10:00:00"),
    ("il y a 1 an", "2024-11-02 10:00:00"),
    ("il y a 2 années", "2023-11-03 10:00:00"),
    ("2 dans le noir", "2023-11-03 10:00:00"),
    ("à l'instant", "2025-11-02 10:00:00"),
    ("il y a 7 lunes", "2025-11-02 10:00:00"),
    ("il y a 99999 ans", None),
    ("il y a 99999999999999999999 minutes", None),
    ("", None),
    (None, None),
])
def test_absolute_date(spark, given_text, expected):
    seen = F.lit(NOW)
    assert each(spark, lambda v: dates.absolute_date(v, seen), [given_text]) == [expected]


def test_utc_day_does_not_depend_on_the_session(spark):
    query = "SELECT timestamp '2025-11-02 23:30:00 UTC' AS ts"
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert spark.sql(query).select(dates.utc_day(F.col("ts"))).first()[0] == dt.date(2025, 11, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert spark.sql("SELECT timestamp '1969-12-31 01:00:00 UTC' AS ts").select(
        dates.utc_day(F.col("ts"))).first()[0] == dt.date(1969, 12, 31)


def test_breadcrumb_place(spark):
    values = [
        "Tout le Maroc > Rabat", "Accueil > Rabat", None, "A > Tout le Maroc > Casa > Autre secteur > X",
        "Tout le Maroc", "A > Tout le Maroc >  Fès  >  Agdal ", "Tout le Maroc > X > أفيتو للعقار",
    ]
    got = each(spark, places.breadcrumb_place, values)
    assert [tuple(r) for r in got] == [
        ("Rabat", None), (None, None), (None, None), ("Casa", None), (None, None), ("Fès", "Agdal"), ("X", None),
    ]


def test_paired_place(spark):
    values = ["Rabat", "Agdal à Rabat", "Hay à Salam à Fès", None]
    got = each(spark, places.paired_place, values)
    assert [(r.neighborhood, r.city) for r in got] == [
        ("Rabat", "Rabat"), ("Agdal", "Rabat"), ("Hay", "Salam"), (None, None),
    ]


def test_category_parts(spark):
    values = [None, "Appartements , à louer", "Villas", ""]
    assert [tuple(r) for r in each(spark, places.category_parts, values)] == [
        ("", None), ("Appartements", "à louer"), ("Villas", None), ("", None),
    ]


def test_offers(spark):
    assert each(spark, places.offer_of_mode, ["vendre", "acheter", "louer", "x", None]) == [
        "vente", "vente", "location", "location", "location",
    ]
    assert each(spark, places.offer_of_phrase, ["à louer", "a louer", "à vendre", "a vendre", "x", None]) == [
        "location", "location", "vente", "vente", None, None,
    ]
    match = lambda phrase: places.offer_matches(phrase, F.lit("vente"))
    assert each(spark, match, ["à vendre", "à louer", None, "x"]) == [True, False, False, False]
    unknown_offer = lambda phrase: places.offer_matches(phrase, F.lit(None).cast("string"))
    assert each(spark, unknown_offer, ["à vendre"]) == [False]


def test_piped_images(spark):
    assert each(spark, bags.piped_images, [None, "a | b|c", " | z | ", ""]) == [None, ["a", "b", "c"], ["z"], []]


def test_json_list(spark):
    assert each(spark, bags.json_list, ['["a","b"]', "[]", None, '{"a":1}', "x"]) == [
        ["a", "b"], [], None, None, None,
    ]


def test_equipment_list(spark):
    values = [
        None, "Ascenseurs; Balcon ; 2 ; 1 mois; Studio; Balcon", "مصعد; Jardin", "Aucune", "",
        "Moire;Éclairage;STUDIO;Studio meublé",
    ]
    assert each(spark, bags.equipment_list, values) == [
        [], ["Ascenseurs", "Balcon"], ["Jardin"], [], [], ["Éclairage", "Studio meublé"],
    ]


def test_attribute_map(spark):
    assert each(spark, bags.attribute_map, ["[1]", None, "x", '{"a":"1","b":null}', '{"n":2}']) == [
        None, None, None, {"a": "1", "b": None}, {"n": "2"},
    ]


def test_named_attributes(spark):
    values = [
        '{"Étage":" 3 ","ETAGE":"1","Etage":"2","المساحة":"9","Salons":null}', "{}", None,
    ]
    got = each(spark, lambda v: bags.named_attributes(bags.attribute_map(v)), values)
    assert got == [{"etage": "1", "salons": None}, {}, None]


def test_list_and_json_text(spark):
    values = [["a", "b"], [], None]
    assert each(spark, lambda v: bags.list_to_text(v, " > "), values, "v array<string>") == ["a > b", None, None]
    assert each(spark, bags.json_or_null, [["é"], [], None], "v array<string>") == ['["é"]', None, None]
    assert each(spark, bags.json_or_null, [{"k": "v"}, {}], "v map<string,string>") == ['{"k":"v"}', None]


def test_flat_html(spark):
    page = (
        '<!-- <a href="/no"> --><script>x="<a href=\'/no\'>"</script>'
        "<A class=x HREF = '/one?a=1&amp;b=2' ><b>One</b> &lt;1&gt;</A><a data-href='/no'>x</a>"
        '<a href=" /two ">Two</a><style>a{}</style>'
    )
    assert each(spark, lambda v: html.attribute_values(v, "a", "href"), [page, None]) == [
        ["/one?a=1&b=2", "/two"], None,
    ]
    assert each(spark, lambda v: html.element_texts(v, "a"), [page]) == [["One <1>", "x", "Two"]]
    page = (
        """<a href="/l'agence_1.htm">x</a><A HREF='/caf&eacute;_2.htm' title="a>b"><a class=x href=/z_3.htm>"""
        """<a data-href="no" href = "/d"><abbr href="n"><a href="1" HREF="2"><a title='x href="q"' href="/t">"""
    )
    assert each(spark, lambda v: html.attribute_values(v, "a", "href"), [page]) == [
        ["/l'agence_1.htm", "/café_2.htm", "/z_3.htm", "/d", "1", "/t"],
    ]
    reader = page_rules.Reader([page_rules.values("a[href]", "href")])
    assert reader.read(page) == (["/l'agence_1.htm", "/café_2.htm", "/z_3.htm", "/d", "1", "/t"],)


def test_references(spark):
    values = [
        "caf&eacute; &amp;lt; &#39;&#x27; &#8364;&#128; &copy &nosuch; &middot;x", "&#0;&#xD800;&#99999999999;", "a&b &", "plain",
        "&#x1F600;&notin;", None,
    ]
    assert each(spark, html.unescape, values) == [v and unescape(v) for v in values]


def test_relative_addresses(spark):
    base = "https://e.test"
    values = [
        "./w_4.htm", "/a/../b_5.htm", "a/b/../../c", "../../x", "/a/./b/", "?q=1", "#f", "", "//h/x/../y", "https://o/a/../b",
        "/a/..", "a/.", "/x?y=/../z", "mailto:a", "..",
    ]
    assert each(spark, lambda v: text.absolute_url(v, base), values) == [urljoin(base, v) for v in values]


def test_dates_of_any_length(spark):
    seen = F.lit("2025-11-02 10:00:00").cast("timestamp")
    values = ["il y a 000000000005 minutes", "il y a 2010 ans", "il y a 2100 ans", "il y a " + "9" * 40 + " jours", "il y a 0 ans", None, ""]
    assert each(spark, lambda v: dates.absolute_date(v, seen), values) == [
        "2025-11-02 09:55:00", "0017-03-04 10:00:00", None, None, "2025-11-02 10:00:00", None, None,
    ]
    problems = each(spark, lambda v: dates.date_problem(v, seen), values)
    assert [p is not None for p in problems] == [False, False, True, True, False, False, False]
