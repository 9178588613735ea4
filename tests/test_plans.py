"""The physical plans are the ones meant for large inputs."""

import re

import pytest
from pyspark.sql import functions as F

from ordermill.operators import deduplicate, match, product_revenue, ranked, split_valid, top_products
from ordermill.workload import QUERIES
from ordermill.workload.tables import table
from tests.conftest import plan

FOLDER = "/root/testdata/sf0.001"
WRITING = {"silver_gold_roundtrip", "order_kpis_snapshot", "csv_daily_sales", "csv_daily_sales_late", "silver_lines",
           "silver_lines_quarantine_first", "gold_lists", "quarantine_sink", "incremental_overwrite", "snapshot_rerun", "partition_upsert"}
#: Queries that store a list or measure groups before their result is asked for.
STORING = {"customer_total_revenue", "total_mismatches", "totals_reconcile", "running_total", "largest_1200_orders", "top_product_per_day_revenue",
           "dense_rank_daily", "dense_rank_all", "rank_top3", "scd2_customer", "scd2_two_columns"}


def count(df, operator):
    return len(re.findall(rf"^\(\d+\) {operator}\b", plan(df), re.MULTILINE))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_pairwise_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text


def test_dedup_cuts_groups_before_the_shuffle(spark):
    df = table(spark, FOLDER, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    unique = deduplicate(df, ["l_orderkey", "l_partkey"], order_by=[F.desc("l_shipdate")])
    assert count(unique, "WindowGroupLimit") == 2 and count(unique, "Exchange") == 1


@pytest.mark.parametrize("how", ["row_number", "rank", "dense_rank"])
def test_top_per_group_cuts_groups_before_the_shuffle(spark, how):
    df = table(spark, FOLDER, "orders").select("o_custkey", "o_totalprice")
    assert count(ranked(df, ["o_custkey"], [("o_totalprice", "desc")], how, 3), "WindowGroupLimit") == 2


def test_overall_top_has_no_global_sort(spark, silver):
    top = top_products(silver, 1)
    assert count(top, "TakeOrderedAndProject") == 1
    assert "rangepartitioning" not in plan(top)
    assert "rangepartitioning" in plan(product_revenue(silver))
    assert "rangepartitioning" not in plan(top_products(silver, 1, "daily"))


def test_product_revenue_is_combined_before_the_shuffle(spark, silver):
    assert count(product_revenue(silver), "HashAggregate") == 4


@pytest.mark.parametrize("top", [100, 101, 1000])
def test_tops_up_to_sparks_threshold_cut_groups(spark, top):
    df = table(spark, FOLDER, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    order = [("o_totalprice", "desc"), ("o_orderkey", "asc")]
    assert count(ranked(df, ["o_custkey"], order, "row_number", top), "WindowGroupLimit") == 2
    assert count(ranked(df, [], order, "row_number", top), "TakeOrderedAndProject") == 1


def test_joins_are_left_to_spark(spark, settings):
    facts = table(spark, FOLDER, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity")
    parts = table(spark, FOLDER, "part").select("p_partkey", "p_name")
    assert count(match(facts, parts, "p_partkey"), "BroadcastHashJoin") == 1
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    assert count(match(facts, parts, "p_partkey"), "SortMergeJoin") == 1


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING - STORING))
def test_building_a_query_starts_no_job_that_reads_rows(spark, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build {name}", name)
    try:
        QUERIES[name](spark, FOLDER)
        jobs = [tracker.getJobInfo(k) for k in tracker.getJobIdsForGroup(f"build {name}")]
        stages = [tracker.getStageInfo(k) for job in jobs for k in job.stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Spark reads a footer per table for its schema: one stage of one task each.
    assert all(stage is None or stage.name.startswith("parquet at") for stage in stages)


def test_scans_read_the_columns_and_rows_they_need(spark):
    text = plan(QUERIES["average_order_value"](spark, FOLDER))
    schemas = re.findall(r"ReadSchema: struct<(.*)>", text)
    lineitem = next(s for s in schemas if "l_orderkey" in s)
    assert {c.split(":")[0] for c in lineitem.split(",")} == {"l_orderkey", "l_partkey", "l_quantity"}
    country = plan(QUERIES["filtered_customers"](spark, FOLDER))
    assert "EqualTo(n_name,NATION_7)" in country


def test_null_checks_reach_the_files(spark, tmp_path, silver):
    silver.write.parquet(str(tmp_path / "t"))
    valid, _ = split_valid(spark.read.parquet(str(tmp_path / "t")))
    assert "IsNotNull(quantity)" in plan(valid)
