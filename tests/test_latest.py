"""The table of newest rows, and the rank in two steps."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from parcelle.operators.versions import latest_per_key, spread_for
from parcelle.plans.silver import latest_listings
from parcelle.queries import inputs
from parcelle.plans import silver
from parcelle.schemas import SILVER
from parcelle.sources import latest, tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def versions(spark, rng, n, ids=40):
    data = []
    for _ in range(n):
        minute = rng.randrange(300)
        data.append((rng.choice([None, *map(str, range(ids))]), rng.choice(["s", "t"]), dt.datetime(2025, 11, 2, minute // 60, minute % 60) if minute else None,
                     rng.choice(["u", None, "v"]), rng.choice(["a", "b", "c"])))
    short = spark.createDataFrame(data, "id string, site string, ingest_ts timestamp, url string, title string")
    return short.select(*(F.col(f.name) if f.name in short.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in SILVER)).repartition(4)


@pytest.fixture
def table(spark):
    name = latest.create_latest_table(spark, buckets=8)
    yield name
    tables.drop_table(spark, name)


def same(a, b):
    shown = ("site", "id", "ingest_ts", "url", "title")
    got, want = (sorted(map(str, df.select(*shown).collect())) for df in (a, b))
    assert got == want


def files_of(spark, name):
    place = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first().data_type.removeprefix("file:")
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{place}/bucket=*/*.parquet")}


def test_merges_come_to_the_newest_of_all(spark, table):
    rng = random.Random(2)
    seen = None
    for n in (60, 200, 5, 90):
        rows = versions(spark, rng, n).cache()
        seen = rows if seen is None else seen.unionByName(rows)
        latest.merge(rows, table)
        same(latest.scan(spark, table), latest_listings(seen))
        assert latest.scan(spark, table).columns == SILVER.names


def test_merging_again_writes_nothing_and_leaves_files(spark, table):
    rows = versions(spark, random.Random(3), 300).cache()
    assert latest.merge(rows, table)
    before = files_of(spark, table)
    assert latest.merge(rows, table) == [] and files_of(spark, table) == before
    newer = rows.where("id = '7' AND site = 's'").limit(1).withColumn("ingest_ts", F.lit(dt.datetime(2026, 1, 1)))
    (touched,) = latest.merge(newer, table)
    after = files_of(spark, table)
    kept = {f for f in before if f"bucket={touched}/" not in f}
    assert kept and {f: after[f] for f in kept} == {f: before[f] for f in kept}
    # A bucket is one folder with one file, so a scan has a task for each.
    assert len(after) == len({os.path.dirname(f) for f in after}) <= 8
    older = rows.where("id = '7' AND site = 's'").withColumn("ingest_ts", F.lit(dt.datetime(2020, 1, 1)))
    assert latest.merge(older, table) == []


def test_the_table_is_never_shuffled(spark, table):
    rows = versions(spark, random.Random(4), 200)
    latest.merge(rows, table)
    there = spark.table(table)
    assert "Exchange" not in plan_of(latest_per_key(there, (latest.KEY.name,), ties=latest.ORDER[1:]))
    assert "Exchange" not in plan_of(there.groupBy(latest.KEY.name).count())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        newest = latest_per_key(latest.keyed(rows), (latest.KEY.name,), ties=latest.ORDER[1:]).repartition(8, latest.KEY.name)
        for df in (latest.changed(there, newest), latest.merged(there, latest.changed(there, newest))):
            plan = plan_of(df)
            # Every exchange stands over the new rows, none over the scan of the table.
            assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
            scans = [text for text in plan.split("\n") if "FileScan parquet" in text]
            assert scans and all("Bucketed: true" in text for text in scans)
            assert not any(is_over(plan, text, scan) for text in plan.split("\n") if "Exchange" in text for scan in scans)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def is_over(plan, upper, lower):
    """Whether a line of a plan is an ancestor of another one, by the columns at which their names begin."""
    lines = plan.split("\n")
    begin = lambda text: len(text) - len(text.lstrip(" :+-"))
    if upper not in lines[:lines.index(lower)]:
        return False
    at = begin(lower)
    for text in reversed(lines[:lines.index(lower)]):
        if text.strip() and begin(text) < at:
            at = begin(text)
            if text == upper:
                return True
    return False


def test_a_table_that_is_not_bucketed_is_refused(spark):
    name = tables.create_silver_table(spark, provider=tables.PARQUET)
    with pytest.raises(ValueError):
        latest.merge(spark.table(name), name)
    tables.drop_table(spark, name)


def test_real_listings_keep_their_newest(spark, sf_dir, table):
    raw = inputs.raw_a(spark, sf_dir)
    middle = raw.selectExpr("percentile(unix_micros(ingest_ts), 0.5) m").first().m
    early, late = raw.where(F.unix_micros("ingest_ts") < middle), raw.where(F.unix_micros("ingest_ts") >= middle)
    for part in (late, early, raw):
        latest.merge(silver.silver_a(part), table)
    want = latest_listings(silver.silver_a(early).unionByName(silver.silver_a(late)))
    assert latest.scan(spark, table).exceptAll(want).isEmpty() and latest.scan(spark, table).count() == want.count()


def test_rank_in_two_steps_gives_the_same_rows(spark):
    tasks, spread = 64, 8
    rows = spark.range(0, 20_000, numPartitions=tasks).selectExpr(
        "if(id % 10 <> 0, if(id % 3 = 0, null, 'hot'), cast(id as string)) as id", "cast(hash(id) as string) as payload", "timestamp_seconds(id % 97) as ingest_ts")
    once, twice = latest_per_key(rows), latest_per_key(rows, spread=spread)
    shuffles = [plan_of(df).count("Exchange") for df in (once, twice)]
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    # What meets in one group: a row of each task of a share, then a row of each share.
    shares = rows.select("id", F.spark_partition_id().alias("task")).where("id = 'hot'").distinct().groupBy(F.col("task") % spread).count()
    assert shares.count() == spread and shares.agg(F.max("count")).first()[0] == tasks // spread
    assert shuffles == [1, 2]


def test_spread_grows_with_the_root_of_the_tasks():
    assert [spread_for(n) for n in (1, 10_000, 1_000_000)] == [1, 1, 1000]
