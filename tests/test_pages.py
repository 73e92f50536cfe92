"""Links and fields of hand-written pages."""

import datetime as dt
import json
import random
import time

import page_tree
import pytest
from pyspark.sql import functions as F

from parcelle import fixed_values as V
from parcelle.operators import page_rules as rules
from parcelle.operators import pages as page_ops
from parcelle.plans import page_records

SEEN = dt.datetime(2025, 11, 2, 10, 0, 0)

PAGE_A = """
<html><body>
<ol class="sc-16q833i-0 x"><li><a href="/">Accueil</a></li><li><a>Tout le Maroc</a></li>
<li><span class="sc-16q833i-2">Casa </span></li><li><a> </a></li></ol>
<h1 class="sc-9ca53b09-5 big">Bel  <b>appartement</b>
 neuf</h1>
<p class="sc-9ca53b09-10">850&nbsp;000 DH</p>
<div class="sc-172bdcdc-0"><span class="sc-1x0vz2r-0 fjZBup">Appartements, à vendre</span></div>
<div class="sc-7378144c-0">Ligne 1<br>Ligne 2 <script>var x;</script></div>
<div class="sc-cd1c365e-1 clDxnX"><img alt="i"><span class="sc-1x0vz2r-0 fjZBup">90 m²</span>
 <span class="sc-1x0vz2r-0 bXFCIH">Surface habitable</span></div>
<div class="sc-cd1c365e-1 clDxnX"><img alt="i"><span class="sc-1x0vz2r-0 bXFCIH">Étage</span></div>
<div class="sc-cd1c365e-1 clDxnX"><img><span class="sc-1x0vz2r-0 fjZBup">3</span>
 <span class="sc-1x0vz2r-0 bXFCIH">Salons</span></div>
<div class="sc-cd1c365e-0 bERAxq"><div class="sc-cd1c365e-1"><span class="sc-1x0vz2r-0 fjZBup">Ascenseur</span></div>
 <div class="sc-cd1c365e-1"><span class="sc-1x0vz2r-0 fjZBup">Parking</span></div><div class="sc-cd1c365e-1"></div></div>
<p class="sc-1l0do2b-9">Agence X</p><svg aria-labelledby="ShopBadgeTitle"></svg>
<div>il y a <time>2 jours</time></div>
<div class="slick-slide"><img src="https://content.avito.ma/1.jpg"><img src="https://other.test/2.jpg"></div>
<div class="slick-slide"><div><img src="https://content.avito.ma/1.jpg"/><img src="https://content.avito.ma/3.jpg"></div></div>
</body></html>
"""

PAGE_M = """
<h1 class="searchTitle">Villa <i>à Rabat</i></h1><h3 class="orangeTit">Prix 1 850 000 DH</h3>
<h3 class="greyTit">Agdal à Rabat</h3>
<div class="adFeatures"><div class="adFeature"><span>Terrasse</span></div><div class="adFeature"><span> </span><span>Ascenseur</span></div></div>
<div class="blockProp"><h4>Description</h4><p>Belle villa<p>Deux</div><div class="blockProp"><p>no</p></div>
<div class="caractBlockProp"><div class="adMainFeature"><p class="adMainFeatureContentLabel">Type de bien</p>
<p class="adMainFeatureContentValue">Villa</p></div>
<div class="adMainFeature"><p class="adMainFeatureContentLabel">Etat</p></div>
<div class="adMainFeature"><p class="adMainFeatureContentLabel">Type de bien</p><p class="adMainFeatureContentValue">Riad</p></div></div>
<div class="flipsnap"><img src="https://x.mubawab-media.com/ad/2.jpg"><img src="https://x.mubawab-media.com/ad/1.jpg"></div>
<div class="picturesGallery"><img src="https://x.mubawab-media.com/ad/1.jpg"><img src="/logo.png"></div>
<div class="businessInfo"><span class="businessName"> Agence Y </span><a href="/fr/agence/1">x</a></div>
"""


def pages(spark, *rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_fields_of_source_a(spark):
    df = pages(spark, (1, "https://e.test/fr/x_123.htm", PAGE_A))
    row = page_records.records_a(df, "acheter", F.lit(SEEN)).first()
    assert row.asDict() == {
        "page_id": 1, "id": "123", "url": "https://e.test/fr/x_123.htm", "error": None,
        "title": "Bel appartement neuf", "price_text": "850 000 DH",
        "breadcrumbs": "Accueil > Tout le Maroc > Casa", "category": "Appartements, à vendre",
        "description": "Ligne 1 Ligne 2", "attributes": '{"Surface habitable":"90 m²"}',
        "equipments": "Ascenseur; Parking", "seller_name": "Agence X", "seller_type": "Boutique",
        "published_date": "2025-10-31 10:00:00",
        "image_urls": "https://content.avito.ma/1.jpg | https://content.avito.ma/3.jpg",
        "listing_type": "vente",
    }


def test_fields_of_source_m(spark):
    df = pages(spark, (1, "https://e.test/fr/a/77/x", PAGE_M))
    row = page_records.records_m(df, "louer").first()
    assert row.asDict() == {
        "page_id": 1, "id": "77", "url": "https://e.test/fr/a/77/x", "error": None,
        "listing_type": "location", "title": "Villa à Rabat", "price": 1850000.0,
        "location_text": "Agdal à Rabat", "features_amenities_json": '["Terrasse","Ascenseur"]',
        "description_text": "Belle villa", "features_main_json": '{"Type de bien":"Riad"}',
        "gallery_urls": '["https://x.mubawab-media.com/ad/1.jpg","https://x.mubawab-media.com/ad/2.jpg"]',
        "agency_name": "Agence Y", "agency_url": V.BASE_URL_M + "/fr/agence/1", "published_date": None,
    }


def test_agency_address_has_to_be_rooted_or_whole(spark):
    block = '<div class="businessInfo"><a href="{}">x</a></div>'
    hrefs = {"agence/1": None, "https://o.test/1": "https://o.test/1", "//c.test/1": "https://c.test/1"}
    df = pages(spark, *((i, "u", block.format(href)) for i, href in enumerate(hrefs)))
    got = page_records.records_m(df, "louer").orderBy("page_id").collect()
    assert [r.agency_url for r in got] == list(hrefs.values())


def test_empty_page_gives_nothing_but_the_address(spark):
    df = pages(spark, (1, "https://e.test/x_1.htm", "<p>rien</p>"))
    row = page_records.records_a(df, "louer", F.lit(SEEN)).first().asDict()
    given = {"page_id", "id", "url", "seller_type", "listing_type"}
    assert {name for name, value in row.items() if value is not None} == given
    assert row["seller_type"] == "Particulier" and row["listing_type"] == "location"


def test_unreadable_page_gives_an_error_row(spark):
    df = pages(spark, (1, "https://e.test/x_1.htm", None), (2, "https://e.test/x_2.htm", PAGE_A))
    bad, good = page_records.records_a(df, "louer", F.lit(SEEN)).orderBy("page_id").collect()
    assert bad.error and (bad.id, bad.listing_type) == ("1", "location")
    assert bad.title is None and bad.seller_type is None
    assert good.error is None and good.title

    def fail(page):
        raise RuntimeError("no such field")

    failing = {"title": rules.text("h1"), "other": rules.Rule("string", fail)}
    rows = page_ops.extract(df, failing).orderBy("page_id").collect()
    assert [r.error for r in rows] == ["page has no text", "no such field"]
    assert [r.title for r in rows] == [None, None]


def test_links_of_source_a(spark):
    html = """
    <section class="sc-b341c660-0"><section><a href="/fr/y_2.htm">2</a></section><a href="/fr/z_3.htm">3</a>
     <a href="/fr/z.htm">no</a></section>
    <a class="sc-1jge648-0 q" href=" /fr/x_1.htm ">1</a><a class="sc-1jge648-0" href="/fr/y_2.htm">2</a>
    <a href="/fr/outside_9.htm">no</a><!-- <a class="sc-1jge648-0" href="/fr/c_8.htm">no</a> -->
    """
    got = page_records.listing_links_a(pages(spark, (1, "u", html))).collect()
    base = V.BASE_URL_A
    assert [(r.pos, r.link) for r in got] == [
        (0, base + "/fr/x_1.htm"), (1, base + "/fr/y_2.htm"), (2, base + "/fr/z_3.htm"),
    ]


def test_links_of_source_m(spark):
    base = V.BASE_URL_M
    html = f"""
    <a href="/fr/a/3/z">3</a><h2 class="listingTit"><a href="/fr/a/2/y">2</a><a href="/fr/b/9">no</a></h2>
    <div class="listingBox" linkref="{base}/fr/a/1/x"></div><div class="listingBox" linkref="/fr/a/8/rel"></div>
    <a href="{base}/fr/a/1/x">1</a><a href="fr/a/7/no">no</a>
    """
    df = pages(spark, (1, "u", html), (2, "u", None))
    links = [base + p for p in ("/fr/a/1/x", "/fr/a/2/y", "/fr/a/3/z")]
    assert [r.link for r in page_records.listing_links_m(df).collect()] == links
    assert [r.link for r in page_records.listing_links_m(df, 2).collect()] == links[:2]


def test_first_links_keep_crawl_order(spark):
    df = pages(spark, (2, "u", '<a href="/b"></a><a href="/c"></a>'), (1, "u", '<a href="/a"></a><a href="/b"></a>'))
    links = page_ops.page_links(df, "https://s.test")
    got = page_ops.first_links(links).collect()
    assert [(r.link[-1], r.page_id, r.pos) for r in got] == [("a", 1, 0), ("b", 1, 1), ("c", 2, 1)]
    assert [r.link[-1] for r in page_ops.first_links(links, 2).collect()] == ["a", "b"]


def test_page_images(spark):
    html = '<img src="https://c.test/1"><img alt="x" src=\'https://c.test/1\'><img src="https://o.test/2"><img>'
    assert page_ops.page_images(pages(spark, (1, "u", html)), "c.test").first().images == ["https://c.test/1"]


def test_flat_and_tree_links_agree(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/pages.parquet")
    flat = page_ops.page_links(given, "")
    tree = page_ops.extract(given, {"hrefs": rules.values("a[href]", "href")}, keep=["page_id"])
    listed = page_ops.positions(tree, F.array_distinct("hrefs"), None)
    assert flat.exceptAll(listed).isEmpty() and listed.exceptAll(flat).isEmpty()


@pytest.mark.parametrize("css, expected", [
    ("p", ["p1", "p2"]), ("div p", ["p1"]), (".k", ["p2"]), ("div.a.b p", ["p1"]), ("div.c p", []),
    ("p, b", ["p1", "p2", "b"]), ('p[id*="2"]', ["p2"]), ("div div p", []),
])
def test_selectors(css, expected):
    page = '<div class="b a"><p id="x1">p1</div><p id="x2" class="k">p2</p><b>b</b>'
    assert rules.Reader([rules.texts(css)]).read(page) == (expected,)


def test_unknown_selectors_are_refused():
    with pytest.raises(ValueError):
        rules.Reader([rules.texts("a > b")])


@pytest.mark.parametrize("page", [
    "<div>" * 200_000 + "x", "<a " * 330_000 + "x", "<b>" * 100_000 + "<li>" * 100_000, "<b>" * 100_000 + "</i>" * 100_000, '<a x="' * 160_000,
    "<a x='\"" * 140_000 + ">", "<!-- <p" * 140_000, "<script>" * 120_000, "< " * 500_000, "<p><div>" * 120_000, "&amp" * 250_000, "<" * 1_000_000,
    '<div class="caractBlockProp"><div class="adMainFeature">' * 18_000 + '<p class="adMainFeatureContentLabel">l</p>', "</p " * 250_000,
])
def test_long_broken_pages_take_time_by_their_length(page):
    """A megabyte, read by the rules of both sources."""
    at_a, at_m = V.SELECTORS_A, V.SELECTORS_M
    reader = rules.Reader([
        rules.texts("b"), rules.values("a", "x"), rules.text(at_a["title"]), rules.texts(at_a["equipment"], inner=at_a["equipment_name"]),
        rules.pairs(at_m["feature"], at_m["feature_label"], at_m["feature_value"]), rules.text("p", within="div.none"), rules.present("svg")])
    start = time.process_time()
    reader.read(page)
    assert time.process_time() - start < 4


NAMES = ["div", "p", "span", "b", "li", "td", "tr", "br", "img", "script", "svg"]


def drawn_page(rng):
    parts = []
    for _ in range(rng.randrange(60)):
        name = rng.choice(NAMES)
        kind = rng.random()
        if kind < 0.5:
            classes = rng.choice(["", ' class="k"', ' class="l k"', " class='l'", " CLASS=k id=x1", ' id="x2" class="m" class="k"', ' title="a>b" data-k'])
            parts.append(f"<{name.upper() if rng.random() < 0.1 else name}{classes}{rng.choice(['', '', '', ' /'])}>")
            if name == "script":
                parts.append("var a = '<b>';</script>")
        elif kind < 0.8:
            parts.append(f"</{name}>")
        else:
            parts.append(rng.choice(["one", " two ", "&eacute;", "a &amp; b", "\n", "x&nbsp;y", "<!-- <p>no</p> -->"]))
    return "".join(parts)


def test_automaton_and_tree_agree():
    rng = random.Random(12)
    for _ in range(1500):
        css = [rng.choice(["div", "p", ".k", "div .k", "div p", "span.l.k", "b, li", "div.k span", "td", "tr td", '[id*="2"]', "p[id]", "div div b", "svg", "script"]) for _ in range(3)]
        glue = rng.choice(["", " "])
        made = [
            lambda m: m.text(css[0], glue=glue), lambda m: m.text(css[0], within=css[1]), lambda m: m.text(css[0], parent=True, glue=glue),
            lambda m: m.texts(css[0], glue=glue), lambda m: m.texts(css[0], inner=css[1]), lambda m: m.values(css[0], "id"),
            lambda m: m.values(css[0], "class", within=css[1]), lambda m: m.present(css[0]), lambda m: m.pairs(css[0], css[1], css[2]),
            lambda m: m.pairs(css[0], css[1], css[2], css[1]),
        ]
        made = rng.sample(made, rng.randrange(1, 4))
        page = drawn_page(rng)
        root = page_tree.read_page(page)
        want = tuple(make(page_tree).take(root) for make in made)
        assert rules.Reader([make(rules) for make in made]).read(page) == want, (css, page)


def test_records_survive_the_round_trip_to_silver(spark):
    from parcelle.operators.payloads import decode_records, kafka_records, raw_envelope
    from parcelle.plans.silver import silver_a, silver_m

    a = page_records.records_a(pages(spark, (1, "https://e.test/fr/x_123.htm", PAGE_A)), "vendre", F.lit(SEEN))
    m = page_records.records_m(pages(spark, (1, "https://e.test/fr/a/77/x", PAGE_M)), "vendre")
    raw = lambda df: raw_envelope(decode_records(kafka_records(df.drop("page_id"))))
    row_a, row_m = silver_a(raw(a)).first(), silver_m(raw(m)).first()
    assert (row_a.id, row_a.price, row_a.surface_habitable, row_a.offre_match) == ("123", 850000.0, "90 m²", True)
    assert (row_m.id, row_m.price, row_m.type_de_bien, row_m.city) == ("77", 1850000.0, "Riad", "Rabat")
    assert json.loads(raw(a).first().payload)["seller_type"] == "Boutique"


def test_a_page_leaves_nothing_to_the_collector_and_tags_are_read_once(monkeypatch):
    import gc

    from parcelle.operators import page_rules

    read, attributes = [], page_rules._attributes
    monkeypatch.setattr(page_rules, "_attributes", lambda tag: read.append(tag) or attributes(tag))
    reader = page_rules.Reader([page_rules.text("p"), page_rules.values("img", "src"), page_rules.values("div img", "alt"), page_rules.pairs("div", "p", "b")])
    page = '<div><img src="a" alt="b"><p>x</p><b>y</b></div><img src="a" alt="b">'
    gc.collect()
    gc.disable()
    try:
        assert reader.read(page) == ("x", ["a", "a"], ["b"], {"x": "y"})
        assert gc.collect() == 0
    finally:
        gc.enable()
    assert read == ['<img src="a" alt="b">']
