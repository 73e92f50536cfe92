"""Versions, parsing and the unified table on hand-written envelopes."""

import datetime as dt
import json

from pyspark.sql import functions as F

from parcelle.operators import attributes, payloads, profiling, versions
from parcelle.functions import bags
from parcelle.plans import silver
from parcelle.queries import inputs
from parcelle.schemas import PAYLOAD_A, PAYLOAD_M, RAW, SILVER

T0 = dt.datetime(2025, 11, 2, 10, 0, 0)


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


def raw(spark, *rows):
    """Envelopes of (payload dict or text, minutes after T0)."""
    return spark.createDataFrame(
        [("k", p if isinstance(p, str) or p is None else json.dumps(p, ensure_ascii=False), minutes(m))
         for p, m in rows], RAW,
    )


def listing(i, url="https://e.test/x_1.htm", **fields):
    return {"id": i, "url": url, **fields}


def test_latest_wins(spark):
    df = raw(spark, (listing("1", title="old"), 0), (listing("1", title="new"), 5), (listing("2", title="only"), 1))
    got = silver.silver_a(df).select("id", "title").collect()
    assert sorted(map(tuple, got)) == [("1", "new"), ("2", "only")]


def test_ties_go_to_the_larger_payload(spark):
    df = raw(spark, (listing("1", title="a"), 0), (listing("1", title="b"), 0)).repartition(4)
    assert [r.title for r in silver.silver_a(df).collect()] == ["b"]


def test_newest_without_address_hides_older(spark):
    df = raw(spark, (listing("1"), 0), (listing("1", url="  "), 5), (listing("2"), 0), (listing("2", url=None), 1))
    assert silver.silver_a(df).count() == 0


def test_cut_json_is_all_null_and_dropped(spark):
    df = raw(spark, ('{"id":"x"', 0), (None, 0), ("", 0), (listing("1"), 0))
    parsed = payloads.parse_payload(df.limit(3), PAYLOAD_A)
    assert all(v is None for row in parsed.drop("ingest_ts").collect() for v in row)
    assert [r.id for r in silver.silver_a(df).collect()] == ["1"]


def test_key_parse_agrees_with_full_parse(spark):
    texts = [
        '{"id":"x"', '{"id":1,"url":"u","price":"abc"}', '{"url":"u"}', "[]", '[{"id":"a","url":"u"}]',
        '{"id":null,"url":" "}', "nonsense", '{"id":"q","url":"u","price":1.5} trailing', None, "{}",
        '{"id":{"a":1},"url":["x"],"price":2}', '{"id":"z","url":"u","price":true,"title":[1,{"b":2}]}',
    ]
    df = raw(spark, *((t, 0) for t in texts))
    for schema in (PAYLOAD_A, PAYLOAD_M):
        full = payloads.parse_payload(df, schema, keep=["payload"])
        keyed = payloads.key_by_document(df, schema)
        want = {r.payload: (r.id, bool(r.url and r.url.strip(" "))) for r in full.collect()}
        assert {r.payload: (r.id, r.addressed) for r in keyed.collect()} == want


def test_null_ids_are_one_group(spark):
    df = raw(spark, ({"url": "u1"}, 0), ({"url": "u2"}, 3), ("broken", 2))
    assert [r.url for r in silver.silver_a(df).collect()] == ["u2"]


def test_fresh_window_includes_the_cut_off(spark):
    df = raw(spark, (listing("1"), 0), (listing("2"), 1), (listing("3"), 35))
    ids = lambda n: sorted(r.id for r in silver.silver_a(df, n, minutes(36)).collect())
    assert ids(35) == ["2", "3"]
    assert ids(36) == ["1", "2", "3"]
    assert ids(0) == ids(-1) == ["1", "2", "3"]


def test_fresh_window_defaults_to_now(spark):
    now = spark.sql("SELECT current_timestamp() AS ingest_ts")
    old = spark.createDataFrame([(T0 - dt.timedelta(days=4000),)], "ingest_ts timestamp")
    assert versions.fresh_window(now.union(old)).count() == 1


def test_freshness_before_and_after_dedup_agree(spark, sf_dir):
    rows = inputs.raw_a(spark, sf_dir)
    as_of, n = dt.datetime(1998, 1, 1), 500_000
    early = silver.silver_a(rows, n, as_of)
    late = versions.fresh_window(silver.silver_a(rows), n, as_of)
    assert early.count() > 0
    assert early.exceptAll(late).isEmpty() and late.exceptAll(early).isEmpty()


def test_one_hot_key_holds_most_rows(spark):
    """A key with two thirds of all rows leaves each map task as a single row."""
    df = spark.range(0, 30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 != 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").cast("string").alias("payload"),
        F.timestamp_seconds(F.col("id")).alias("ingest_ts"),
    )
    got = versions.latest_per_key(df)
    assert got.count() == 10_001
    assert got.filter("id = 'hot'").first().payload == "29999"


def test_unified_columns_and_types(spark):
    a = silver.silver_a(raw(spark, (listing("1"), 0)))
    m = silver.silver_m(raw(spark, (listing("1"), 0)))
    for df in (a, m, a.unionByName(m)):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SILVER]
    assert len(SILVER) == 41


def test_full_listing_a(spark):
    row = silver.silver_a(raw(spark, (listing(
        "7", price_text="850 000 DH", breadcrumbs="Accueil > Tout le Maroc > Casa > Maârif",
        category="Appartements, à vendre", description="d", equipments="Ascenseur; Parking",
        attributes='{"Étage":"3 ","Type d\'appartement":"T3","Inconnu":"x"}', seller_name=" Agence ",
        image_urls="i1 | i2", listing_type="vente", published_date="2025-11-01 00:00:00",
    ), 0))).first()
    assert (row.site, row.offre, row.price, row.seller) == ("avito", "vente", 850000.0, "agence")
    assert (row.city, row.neighborhood, row.property_type) == ("Casa", "Maârif", "Appartements")
    assert (row.images, row.equipments, row.offre_match) == (["i1", "i2"], ["Ascenseur", "Parking"], True)
    assert (row.etage, row.type_d_appartement, row.salons) == ("3", "T3", None)
    assert row.type_de_bien is None and row.ingest_ts == T0


def test_full_listing_m(spark):
    row = silver.silver_m(raw(spark, (listing(
        "8", price=0, location_text="Agdal à Rabat", features_amenities_json='["Terrasse"]',
        features_main_json='{"Type de bien":" Villa ","Étage du bien":"2"}', gallery_urls='["a"]',
        agency_name="NaN", listing_type="location", description_text="d",
    ), 0))).first()
    assert (row.site, row.price, row.seller) == ("mubawab", None, "unknown")
    assert (row.city, row.neighborhood) == ("Rabat", "Agdal")
    assert (row.property_type, row.type_de_bien, row.etage_du_bien) == (" Villa ", "Villa", "2")
    assert (row.images, row.equipments, row.offre_match) == (["a"], None, None)
    assert row.features_amenities_json == '["Terrasse"]'


def test_latest_listings_of_an_append_only_table(spark):
    a = silver.silver_a(raw(spark, (listing("1", title="old"), 0)))
    b = silver.silver_a(raw(spark, (listing("1", title="new"), 5)))
    m = silver.silver_m(raw(spark, (listing("1"), 0)))
    got = silver.latest_listings(a.union(a).union(b).union(m)).select("site", "id", "title").collect()
    assert sorted(map(tuple, got), key=str) == [("avito", "1", "new"), ("mubawab", "1", None)]


def test_envelope_prefers_the_document_id(spark):
    records = spark.createDataFrame(
        [(b"k1", b'{"id":null}'), (b"k2", b'{"id":"d"}'), (None, b'{"v":1}'), (b"k3", b"broken"), (b"k4", None)],
        "key binary, value binary",
    )
    got = payloads.raw_envelope(payloads.decode_records(records)).select("id", "payload").collect()
    assert [tuple(r) for r in got] == [
        ("k1", '{"id":null}'), ("d", '{"id":"d"}'), (None, '{"v":1}'), ("k3", "broken"), ("k4", None),
    ]


def test_kafka_records_keep_nulls_and_letters(spark):
    df = spark.createDataFrame([("1", "é", None), (None, "x", 2.0)], "id string, title string, price double")
    got = payloads.kafka_records(df).collect()
    assert bytes(got[0].key) == b"1" and got[1].key is None
    assert json.loads(got[0].value.decode()) == {"id": "1", "title": "é", "price": None}
    assert "é".encode() in bytes(got[0].value)


def test_pivoted_attributes_and_rows(spark):
    df = spark.createDataFrame(
        [("1", '{"Étage":"3 ","title":"no"}'), ("2", '{"Vue mer":"oui","مساحة":"1"}'), ("3", None)],
        "title string, a string",
    )
    bag = bags.attribute_map(F.col("a"))
    rows = attributes.attribute_rows(df, bag, ["title"]).collect()
    assert sorted(map(tuple, rows)) == [("1", "etage", "3"), ("1", "title", "no"), ("2", "vue_mer", "oui")]
    got = attributes.pivoted_attributes(df, bag, ["etage", "title", "vue_mer"], ["title"])
    assert got.columns == ["title", "etage", "vue_mer"]
    assert sorted(map(tuple, got.collect())) == [("1", "3", None), ("2", None, "oui"), ("3", None, None)]


def test_labels_read_as_fields_or_through_a_map_agree(spark):
    labels = ["Étage", "Salons", "Type d'appartement"]
    texts = [
        '{"Étage":" 3 ","Salons":"1"}', '{"Étage":"3","ETAGE":"1"}', '{"étage":"2","Salons":null}',
        '{"Étage":{"a":1},"Salons":[1,"x"]}', '{"Salons":7,"Étage":true}', "{}", None, "", "nonsense", "[1]",
        '[{"Étage":"3"}]', '{"Étage":"3"', '{"Étage":"3"} more', '"Étage"', '{"type_d_appartement":"T2"}',
        '{"Type d\'appartement":"T3","Autre":"x"}', "null", ' {"Étage":"4"}', '{"":"x","Étage":"5"}',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    names = ["etage", "salons", "type_d_appartement"]
    direct = attributes.labelled_attributes(df, "a", labels).select("a", *names)
    through_map = df.withColumn("m", bags.named_attributes(bags.attribute_map(F.col("a")))).select(
        "a", *(F.col("m")[n].alias(n) for n in names))
    assert sorted(map(tuple, direct.collect()), key=str) == sorted(map(tuple, through_map.collect()), key=str)
    got = {r.a: tuple(r)[1:] for r in direct.collect()}
    assert got['{"Étage":"3","ETAGE":"1"}'] == ("1", None, None)
    assert got['{"étage":"2","Salons":null}'] == ("2", None, None)
    assert got['[{"Étage":"3"}]'] == (None, None, None)


def test_profiles(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    assert [tuple(r) for r in profiling.value_counts(df, "id").collect()] == [("b", 2), (None, 1), ("a", 1)]
    assert [tuple(r) for r in profiling.value_counts(df, "id", top=1).collect()] == [("b", 2)]
    assert [tuple(r) for r in profiling.duplicate_ids(df).collect()] == [("b", 2)]
    flat = profiling.preview(spark.createDataFrame([("a\r\n\tb", 1)], "t string, n int"), 5)
    assert flat.toPandas().t[0] == "a b"


def test_inputs_fill_every_unified_column(spark, sf_dir):
    """Checks over the unified table can fail for every column: each has values, and booleans have both."""
    both = silver.silver_all(inputs.raw_a(spark, sf_dir), inputs.raw_m(spark, sf_dir))
    filled = both.agg(*(F.count(c).alias(c) for c in both.columns), F.countDistinct("offre_match").alias("matches")).first().asDict()
    assert filled.pop("matches") == 2
    assert [name for name, n in filled.items() if not n] == []
    ids = inputs.listing_a(spark, sf_dir).groupBy("id").count()
    assert 0 < ids.where("count > 1").count() < ids.count()
