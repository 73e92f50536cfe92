"""Missing values, empty and long texts, ties, repeated rows, empty tables and other columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parcelle.llm import chat, decontaminate, licences, main_text, maxent, near_dedup, packing, pii, quality, secrets

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, row long, cls string, n_words long, spans string, "
    "hash long, size long, id long, base string, core string, group_0 string, _own string, label string"
)
LONG = "word " * 60_000 + "x" * 100_000
TEXTS = {
    1: None, 2: "", 3: " \n\t ", 4: "one", 5: "one two three four", 6: "Café \U0001F600 naïve Été ok a b c d e f g h",
    7: LONG, 8: "same text here for a copy of it all", 9: "same text here for a copy of it all",
}


def rows():
    out = [(k, t, "en" if k % 2 else None, "s" if k % 3 else None, None) for k, t in TEXTS.items()]
    out += [out[-1], (None, None, None, None, 3), (None, "no key but some words in it, ten of them at least", "en", "s", 49)]
    return [(*r, "k", 1, "c", 7, "s", 1, 2, 3, "b", "c", "g", "o", "l") for r in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "same text here for a copy of it all"), (2, None), (3, ""), (None, "no one has these words")], "item_id long, text string")


def operators(items):
    return {
        "near_dedup": (near_dedup.near_duplicates, True), "personal_data": (pii.personal_data, True), "secrets": (secrets.secret_scan, True),
        "licences": (licences.licence_scan, True), "quality": (quality.quality_rules, True), "maxent": (maxent.score_texts, True),
        "packing": (packing.pack_documents, False), "leaks": (lambda d: decontaminate.leaks(d, items), False),
    }


@pytest.mark.parametrize("name", list(operators(None)))
def test_edge_rows(docs, none, items, name):
    operator, row_for_row = operators(items)[name]
    found = operator(docs)
    assert found.columns[0] == "doc_id" and len(set(found.columns)) == len(found.columns)
    got = found.collect()
    if row_for_row:
        count = sorted(str(r[0]) for r in rows())
        assert sorted(str(r["doc_id"]) for r in got) == count
    empty = operator(none)
    assert empty.columns == found.columns and empty.collect() == []


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_defined_results(docs, items):
    near = by_id(near_dedup.near_duplicates(docs))
    assert [near[k]["n_shingles"] for k in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 1]
    assert [near[k]["component_id"] for k in (1, 2, 8, 9)] == [1, 2, 8, 8] and not near[9]["kept"]
    assert near[None]["kept"]
    rules = by_id(quality.quality_rules(docs))
    assert all(rules[k]["base_failed"] and not rules[k]["kept"] for k in (1, 2, 3, 4, 5, 7))
    assert rules[6]["n_words"] == 13 and rules[6]["kept"]
    text = by_id(secrets.secret_scan(docs))
    assert text[1]["spans"] == [] and text[7]["base"] == []
    licence = by_id(licences.licence_scan(docs))
    assert licence[1]["n_words"] == 0 and licence[1]["labels"] == "" and licence[7]["n_words"] == 60_001
    leaked = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).collect()}
    assert leaked == {(8, 1), (9, 1)}
    score = by_id(maxent.score_texts(docs))
    assert score[1]["n_tokens"] == 1 and score[7]["n_tokens"] == 60_002
    pieces = packing.pack_documents(docs).where("doc_id in (1, 2, 3)").collect()
    assert [(p["piece"], p["start"], p["length"]) for p in pieces] == [(0, 0, 1)] * 3


def test_pages(spark):
    schema = "page_id long, url string, html string, text string, n_chars long"
    pages = spark.createDataFrame([(1, None, None, "t", 1), (2, "u", "", "t", 1), (2, "u", "", "t", 1), (None, "u", "<p>a", "t", 1), (5, "u", "<p>" + "long text, " * 50_000, "t", 1)], schema)
    found = main_text.extract_main_text(pages).collect()
    assert sorted((str(r["page_id"]), r["text"][:9], r["n_chars"]) for r in found) == [("1", "", 0), ("2", "", 0), ("2", "", 0), ("5", "long text", 549_999), ("None", "a", 1)]
    assert main_text.extract_main_text(spark.createDataFrame([], schema)).collect() == []


def test_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, part long, id long, state string"
    turns = [(1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 1, "SYSTEM ", "s"), (None, 1, "bot", "x"), (None, 2, "?", "")]
    found = chat.repair_chats(spark.createDataFrame([(*t, 1, 1, "x") for t in turns], schema)).orderBy("conv_id", "out_turn", "place").collect()
    got = [(r["conv_id"], r["out_turn"], r["role"], r["text"], r["action"]) for r in found]
    assert got[:3] == [(None, 0, "user", "", "insert"), (None, 1, "assistant", "x", "keep"), (None, 2, "user", "", "relabel")]
    assert got[3] == (1, 0, "user", "", "relabel")
    assert sorted(got[4:7]) == [(1, 0, "user", t, "merge") for t in "aab"]
    assert got[7:] == [(2, 0, "system", "s", "keep"), (2, 1, "user", "", "insert")]
    assert chat.repair_chats(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("number", range(5))
def test_stages(spark, docs, none, items, tmp_path, number):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    name, stage = corpus_pipeline.STAGES[number]
    found = stage(spark, docs, str(tmp_path))
    if number < 4:
        assert found.columns == docs.columns
        kept = found.select("doc_id", F.substring("text", 1, 50)).collect()
        assert all(r in docs.select("doc_id", F.substring("text", 1, 50)).collect() for r in kept)
    assert found.count() > 0
    assert stage(spark, none, str(tmp_path)).collect() == []
