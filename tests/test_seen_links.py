"""Links that earlier runs gave are not given again."""

import random

import pytest

from parcelle.jobs import read_pages
from parcelle.sources import seen_links, tables


@pytest.fixture
def name(spark):
    made = seen_links.create_seen_table(spark, "test", buckets=8)
    yield made
    tables.drop_table(spark, made)


def links(spark, numbers):
    return spark.createDataFrame([(f"https://e.test/x_{k}.htm", k, 0) for k in numbers], "link string, page_id long, pos int").repartition(4)


def test_only_new_links_whatever_the_filter_says(spark, name, monkeypatch):
    rng = random.Random(1)
    known: set[int] = set()
    for n, bits in ((200, None), (500, 1 << 16), (800, 0), (300, None)):
        if bits is not None:  # a filter that is nearly full, or none
            monkeypatch.setattr(seen_links, "filter_bits", lambda count, bits=bits: bits)
        asked = rng.sample(range(2000), n)
        found = seen_links.unseen(links(spark, asked), name)
        assert found.columns == ["link", "page_id", "pos"]
        got = {r.page_id for r in found.collect()}
        assert got == set(asked) - known and len(found.collect()) == len(got)
        seen_links.record(found, name)
        known |= got
        monkeypatch.undo()
    assert spark.table(name).count() == len(known) == spark.table(name).select("link").distinct().count()
    assert seen_links.unseen(links(spark, asked), name).isEmpty()


def test_filter_knows_all_and_little_else(spark):
    seen = links(spark, range(5000))
    bits = seen_links.filter_bits(5000)
    bitmaps = seen_links.filter_of(seen, bits)
    maybe = seen_links.may_be_in(links(spark, range(10_000)), bitmaps, bits)
    counts = {(r[0], r[1]): r[2] for r in maybe.selectExpr("page_id < 5000 known", "maybe").groupBy("known", "maybe").count().collect()}
    assert (True, False) not in counts and counts[True, True] == 5000
    assert counts.get((False, True), 0) < 0.1 * 5000


def test_filter_is_sized_by_the_count():
    assert [seen_links.filter_bits(n) for n in (0, 1000, 100_000, 16_000_000, 17_000_000)] == [1 << 16, 1 << 16, 1 << 21, 1 << 28, 0]


def test_known_links_are_not_shuffled(spark, name):
    seen_links.record(links(spark, range(100)), name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    plan = seen_links.unseen(links(spark, range(200)).repartition(8, "link"), name)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and "LeftAnti" in plan


def test_job_gives_each_link_once(spark, tmp_path):
    pages = str(tmp_path / "pages")
    def write(*rows):
        spark.createDataFrame([(k, "u", h) for k, h in rows], "page_id long, url string, html string").write.mode("overwrite").parquet(pages)
    def run(number):
        out = str(tmp_path / f"csv{number}")
        read_pages.main(["--source", "mubawab", "--what", "links", "--new", "--per-page", "0", "--pages", pages, "--out", out])
        return sorted(r["link"][-4:] for r in spark.read.option("header", True).csv(out).collect())
    many = "".join(f'<a href="/fr/a/{k:04d}">x</a>' for k in range(40))
    write((1, many))
    assert len(run(1)) == 40  # all links of a page
    assert run(2) == []
    write((2, '<a href="/fr/a/0001">x</a><a href="/fr/a/7777">x</a>'))
    assert run(3) == ["7777"]
    tables.drop_table(spark, "raw.mubawab_seen_links")
