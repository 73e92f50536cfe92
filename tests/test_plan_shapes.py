"""Physical plans keep the shape that holds at scale."""

import datetime as dt
import re

import pytest

from parcelle.functions import bags
from parcelle.operators import attributes
from parcelle.operators.versions import latest_per_key
from parcelle.plans import silver
from parcelle.queries import QUERIES
from parcelle.queries import inputs
from parcelle.session import shuffle_partitions_for, sized_shuffles
from parcelle.sources import tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "a")
    sf_dir = __import__("conftest").SF
    tables.with_partition(inputs.raw_a(spark, sf_dir)).repartition("ingest_date").limit(300) \
        .write.partitionBy("ingest_date").parquet(path)
    return path


def test_silver_is_one_shuffle(spark, raw):
    plan = plan_of(silver.silver_a(tables.scan_files(spark, raw)))
    assert plan.count("Exchange") == 1
    assert plan.count("FileScan") == 1
    # One row per key leaves each map task, whatever the key's share of the rows.
    assert re.search(r"Exchange hashpartitioning\(id.*?\n.*WindowGroupLimit.*Partial", plan)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "MapInPandas" not in plan


def shuffled_rows(plan):
    """Rows written to shuffles below a plan that has run."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled_rows(plan.executedPlan())
    if kind == "ShuffleQueryStageExec":
        return plan.shuffle().metrics().apply("shuffleRecordsWritten").value()
    if kind == "ResultQueryStageExec":
        return shuffled_rows(plan.plan())
    children = plan.children()
    return sum(shuffled_rows(children.apply(i)) for i in range(children.size()))


def test_a_hot_key_is_one_row_per_map_task(spark):
    rows = spark.range(0, 30_000, numPartitions=6).selectExpr(
        "if(id % 3 <> 0, 'hot', cast(id as string)) as id", "cast(id as string) as payload",
        "timestamp_seconds(id) as ingest_ts",
    )
    newest = latest_per_key(rows)
    assert len(newest.collect()) == 10_001
    assert shuffled_rows(newest._jdf.queryExecution().executedPlan()) == 10_000 + 6


def test_full_parse_comes_after_the_cut(spark, raw):
    plan = plan_of(silver.silver_a(tables.scan_files(spark, raw)))
    above, below = plan.split("Window [", 1)
    assert "price_text,StringType" in above and "price_text" not in below
    assert "ReadSchema: struct<payload:string,ingest_ts:timestamp>" in below


def parsed_fields(plan):
    """Fields of each parse of a payload in a plan."""
    found = re.findall(r"from_json\(((?:StructField\([^)]*\),?\s*)+)", plan)
    return sorted(part.count("StructField(") for part in found)


def test_attribute_texts_are_read_once(spark, sf_dir):
    plan = plan_of(QUERIES["attr_columns"](spark, sf_dir))
    assert plan.count("from_json(MapType(StringType,StringType,true), attributes") == 1 and "json_object_keys(attributes" not in plan


def test_few_columns_parse_few_fields(spark, sf_dir):
    for name, most in (("avg_price_offer", 2), ("count_city_offer", 2), ("silver_sample", 5)):
        fields = parsed_fields(plan_of(QUERIES[name](spark, sf_dir)))
        assert fields and max(fields) <= most, (name, fields)


def test_chosen_columns_are_those_of_the_whole_table(spark, sf_dir):
    raw_a, raw_m = inputs.raw_a(spark, sf_dir), inputs.raw_m(spark, sf_dir)
    for chosen in (["id", "property_type", "etat"], ["city", "offre_match"], ["images", "price", "seller"]):
        whole = silver.silver_all(raw_a, raw_m).select(*chosen)
        part = silver.silver_all(raw_a, raw_m, columns=chosen)
        assert part.select(*chosen).exceptAll(whole).isEmpty() and part.count() == whole.count()


def test_freshness_reaches_the_scan(spark, raw):
    fresh = silver.silver_a(tables.scan_files(spark, raw, minutes=35, as_of=dt.datetime(1998, 1, 1)))
    scan = plan_of(fresh).split("FileScan", 1)[1]
    assert "PartitionFilters: [isnotnull(ingest_date" in scan
    assert "PushedFilters: [IsNotNull(ingest_ts), GreaterThanOrEqual(ingest_ts" in scan


def test_union_scans_each_source_once(spark, raw):
    both = silver.silver_all(tables.scan_files(spark, raw), tables.scan_files(spark, raw))
    plan = plan_of(both)
    assert plan.count("FileScan") == 2 and plan.count("Exchange") == 2


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_crosses_or_collects(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "SinglePartition"):
        allowed = bad == "SinglePartition" and "HashAggregate(keys=[]" in plan
        assert bad not in plan or allowed


def test_top_k_is_not_a_sort(spark, sf_dir):
    for name in ("freq_seller", "page_links_capped", "preview_clean", "silver_sample"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_counts_are_combined_before_the_shuffle(spark, sf_dir):
    for name in ("freq_seller", "freq_equipments", "dup_ids", "page_links_unique", "count_city_offer"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert "partial_" in plan and "SortAggregate" not in plan


def test_attribute_rows_do_not_shuffle_rows(spark, raw):
    df = tables.scan_files(spark, raw).select("id", "payload")
    plan = plan_of(attributes.attribute_rows(df, bags.attribute_map(df.payload), ["id"]))
    assert "Exchange" not in plan


def test_shuffles_are_sized_by_the_input(spark, raw):
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    scanned = tables.scan_files(spark, raw)
    assert shuffle_partitions_for(scanned) == int(before)
    with sized_shuffles(scanned, bytes_per_partition=1) as partitions:
        assert int(spark.conf.get(setting)) == partitions > 100_000
    assert spark.conf.get(setting) == before


def test_no_query_deals_its_input_out(spark, sf_dir):
    for name, query in QUERIES.items():
        assert "RoundRobin" not in plan_of(query(spark, sf_dir)), name
