"""Labels of the data become columns, without a change of code and without reading old days."""

import datetime as dt
import json

import pytest

from parcelle.jobs import build_silver, create_tables
from parcelle.schemas import RAW, SILVER
from parcelle.sources import labels, tables


def raw(spark, path, day, *bags):
    rows = [
        (f"{day}-{k}", json.dumps({"id": f"{day}-{k}", "url": "u", "title": f"t{k}", "attributes": json.dumps(bag) if isinstance(bag, dict) else bag}), dt.datetime(2025, 11, day, 12))
        for k, bag in enumerate(bags)
    ]
    tables.with_partition(spark.createDataFrame(rows, RAW)).write.mode("append").partitionBy("ingest_date").parquet(path)


@pytest.fixture
def built(spark, tmp_path):
    create_tables.main(["--provider", "parquet", "--silver"])
    yield lambda path: build_silver.main(["--provider", "parquet", "--source", "avito", "--raw-files", path, "--window-mins", "0", "--mode", "merge", "--labels"])
    for name in ("silver.listings_all", "silver.attribute_labels"):
        tables.drop_table(spark, name)


def table(spark, *columns):
    return {r[0]: tuple(r)[1:] for r in tables.scan(spark, "silver.listings_all").select("id", *columns).collect()}


def test_new_labels_reach_columns(spark, tmp_path, built):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    raw(spark, old, 1, {"Chambres": "3"}, {"Chambres": "2", "Étage": " 4 "}, None, "no object")
    built(old)
    assert tables.scan(spark, "silver.listings_all").columns == SILVER.names
    known = {r["label"] for r in spark.table("silver.attribute_labels").collect()}
    assert known == {"Chambres", "Étage"}

    # Two spellings of one name, a name of a base column, one of a usual label, and one without Latin letters.
    raw(spark, new, 2, {"Vue sur mer": " oui "}, {"vue  SUR mer": "b", "Vue sur mer": "a"}, {"Price": "7", "site": "x", "chambres": "9"}, {"海": "1", "Piscine!": "2"})
    built(new)
    assert tables.scan(spark, "silver.listings_all").columns == [*SILVER.names, "piscine", "vue_sur_mer"]
    assert table(spark, "vue_sur_mer", "piscine", "chambres", "site", "price") == {
        "1-0": (None, None, "3", "avito", None), "1-1": (None, None, "2", "avito", None), "1-2": (None, None, None, "avito", None),
        "1-3": (None, None, None, "avito", None), "2-0": ("oui", None, None, "avito", None), "2-1": ("a", None, None, "avito", None),
        "2-2": (None, None, "9", "avito", None), "2-3": (None, "2", None, "avito", None),
    }
    assert spark.table("silver.attribute_labels").where("label = 'Vue sur mer'").first()["first_day"] == dt.date(2025, 11, 2)

    count, kept = spark.table("silver.attribute_labels").count(), table(spark, "vue_sur_mer")
    built(new)  # nothing new: no label twice, no row twice
    assert spark.table("silver.attribute_labels").count() == count and table(spark, "vue_sur_mer") == kept

    # A run that does not know the labels writes NULLs there.
    raw(spark, str(tmp_path / "more"), 3, {"Vue sur mer": "oui"})
    build_silver.main(["--provider", "parquet", "--source", "avito", "--raw-files", str(tmp_path / "more"), "--window-mins", "0"])
    assert table(spark, "vue_sur_mer")["3-0"] == (None,)


def test_a_run_reads_its_own_rows_alone(spark, tmp_path, built):
    path = str(tmp_path / "raw")
    for day in (1, 2, 3):
        raw(spark, path, day, {f"Label {day}": "x"})
    fresh = tables.scan_files(spark, path, minutes=60, as_of=dt.datetime(2025, 11, 3, 12, 30))
    name = labels.create_label_table(spark, provider=tables.PARQUET)
    plan = labels.labels_of(fresh, *labels._FIELDS["avito"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and plan.count("FileScan") == 1 and "partial_min" in plan
    assert labels.follow(fresh, "avito", name, "silver.listings_all") == ["label_3"]
    assert labels.follow(fresh, "avito", name, "silver.listings_all") == ["label_3"]
    assert labels.names_of(spark, name, "mubawab") == []
