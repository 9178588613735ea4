"""The paths for crowded keys give the same rows as the plain ones."""

import re

import pytest
from pyspark.sql import Window, functions as F

from ordermill.operators import deduplicate, match, neighbour, prefix_sum, ranked, row_numbers, running_total, scd2, with_customer_total
from ordermill.operators.metrics import product_totals
from ordermill.operators.skew import crowded_keys, group_sizes
from ordermill.workload import QUERIES
from ordermill.workload.tables import order_lines
from ordermill.workspace import file_bytes
from tests.conftest import plan, tuples


@pytest.fixture(scope="module")
def facts(spark):
    """One key with a third of all rows, a crowd of exact copies, and rows without a key."""
    return (
        spark.range(900)
        .select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 40)
            .cast("int").alias("k"),
            F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("id") % 100).alias("v"),
            "id",
        )
        .withColumn("amount", F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id")).cast("decimal(18,2)"))
        .repartition(4)
    )


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(0, 30).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), "id").alias("name")).unionByName(
        spark.sql("SELECT CAST(null AS INT) AS k, 'none' AS name"))


def test_group_sizes_and_crowded_keys(facts):
    assert group_sizes(facts, ["k"]).rows == 900
    assert group_sizes(facts, []).largest == 900
    counts = facts.groupBy("k").count()
    assert crowded_keys(counts, ["k"], 1000) is None
    largest = group_sizes(facts, ["k"]).largest
    assert tuples(crowded_keys(counts, ["k"], 100)) == [(7, -(-largest // 100))]
    assert tuple(group_sizes(facts.limit(0), ["k"])) == (0, 0)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_spread_join_equals_plain_join(facts, dim, how, null_safe):
    condition = facts.k.eqNullSafe(dim.k) if null_safe else facts.k == dim.k
    plain = facts.join(dim, condition, how).drop(dim.k)
    left_to_spark = match(facts, dim, "k", how, null_safe=null_safe)
    spread = match(facts, dim, "k", how, null_safe=null_safe, left_counts=facts.groupBy("k").count(), group_rows=20)
    assert left_to_spark.columns == spread.columns == plain.columns
    assert tuples(left_to_spark) == tuples(spread) == tuples(plain)


def test_spread_join_uses_many_tasks(facts, dim):
    crowd = facts.where("k = 7")
    spread = match(crowd, dim, "k", left_counts=crowd.groupBy("k").count(), group_rows=20).hint("merge")
    assert spread.select(F.spark_partition_id()).distinct().count() > 1


def test_spread_join_with_several_rows_per_key(facts, dim):
    twice = dim.unionByName(dim.withColumn("name", F.lit("again")))
    assert tuples(match(facts, twice, "k", left_counts=facts.groupBy("k").count(), group_rows=20)) == tuples(facts.join(twice, "k").select(*facts.columns, "name"))


def test_match_checks_its_arguments(facts, dim):
    with pytest.raises(ValueError):
        match(facts, dim, "k", "full")


def test_adaptive_execution_splits_a_hot_key(spark, facts, dim, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
             spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1k", spark__sql__adaptive__advisoryPartitionSizeInBytes="1k",
             spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.1", spark__sql__adaptive__coalescePartitions__enabled="false")
    wide = facts.withColumn("text", F.sha2(F.col("id").cast("string"), 512))
    joined = match(wide, dim.withColumn("more", F.sha2("name", 512)), "k")
    assert joined.count() == facts.join(dim, "k").count()
    rows = joined.collect()
    assert rows and "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["decimal(18,2)", "decimal(30,10)", "decimal(38,10)", "int", "bigint", "double"])
@pytest.mark.parametrize("group", [["k"], []])
def test_sliced_sums_have_the_plain_type_and_value(facts, kind, group):
    value = (F.col("id") * F.lit("0.0000000004" if kind == "decimal(30,10)" else "0.25").cast("decimal(20,10)")).cast(kind)
    rows = facts.select("k", "id", F.when(F.col("id") % 11 != 0, value).alias("x"))
    window = Window.partitionBy(*group).orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    native = rows.withColumn("run_total", F.sum("x").over(window))
    for group_rows in (20, 10_000):
        got = running_total(rows, group, ["id"], "x", group_rows=group_rows)
        assert got.dtypes == native.dtypes
        assert tuples(got) == tuples(native)


@pytest.mark.parametrize("group", [["k"], []])
@pytest.mark.parametrize("how", ["row_number", "rank", "dense_rank"])
def test_rows_agree_across_the_native_top(facts, group, how, monkeypatch):
    from ordermill.operators import ranking

    order = [("v", "desc"), ("id", "asc")]
    for top in (99, 100, 101):
        native = tuples(ranked(facts, group, order, how, top))
        with monkeypatch.context() as patch:
            patch.setattr(ranking, "NATIVE_TOP", 100)
            got = ranked(facts, group, order, how, top, group_rows=30)
            assert tuples(got) == native


@pytest.mark.parametrize("group", [["k"], []])
@pytest.mark.parametrize("descending", [False, True])
def test_sliced_prefix_sum_and_row_numbers(facts, group, descending):
    order = [F.col("v").desc() if descending else F.col("v"), F.col("id")]
    assert tuples(prefix_sum(facts, group, order, F.col("amount"), "s", 30)) == tuples(
        prefix_sum(facts, group, order, F.col("amount"), "s"))
    assert tuples(row_numbers(facts, group, order, "n", 30)) == tuples(row_numbers(facts, group, order, "n"))


def test_sliced_prefix_sum_splits_exact_copies(facts):
    copies = facts.select(F.lit(1).alias("k"), F.lit(2).alias("v"))
    got = running_total(copies, ["k"], ["v"], "v", group_rows=50)
    assert tuples(got) == sorted(((1, 2, 2 * n) for n in range(1, 901)), key=repr)


@pytest.mark.parametrize("step", [-1, 1])
@pytest.mark.parametrize("column", ["id", "amount"])
def test_sliced_neighbours(facts, step, column):
    order = [F.col("v").desc(), F.col("id")]
    sliced, native = neighbour(facts, ["k"], order, column, "other", step, 30), neighbour(facts, ["k"], order, column, "other", step)
    assert tuples(sliced) == tuples(native) and sliced.dtypes == native.dtypes
    with pytest.raises(ValueError):
        neighbour(facts, ["k"], order, column, "other", 2)


@pytest.mark.parametrize("how", ["row_number", "rank", "dense_rank"])
@pytest.mark.parametrize("top", [None, 1, 3, 200])
@pytest.mark.parametrize("group", [["k"], []])
def test_ranks_of_crowded_groups(facts, how, top, group):
    order = [("v", "desc")] + ([("id", "asc")] if how == "row_number" else [])
    spread = ranked(facts, group, order, how, top, group_rows=30)
    plain = ranked(facts, group, order, how, top)
    assert spread.columns == plain.columns and spread.dtypes == plain.dtypes
    assert tuples(spread) == tuples(plain)


def test_ranks_check_their_arguments(facts):
    with pytest.raises(ValueError):
        ranked(facts, ["k"], [("v", "desc")], "ntile")


def test_customer_total_of_a_crowded_customer(facts):
    lines = facts.select(F.col("k").alias("customer_id"), "id", F.col("amount").alias("line_amount"))
    plain, spread = (with_customer_total(lines, group_rows=group_rows) for group_rows in (10_000, 50))
    by_window = lines.withColumn("customer_total_revenue", F.sum("line_amount").over(Window.partitionBy("customer_id")))
    assert tuples(plain) == tuples(spread) == tuples(by_window) and plain.dtypes == spread.dtypes
    assert "_right_part" in plan(spread) and "_right_part" not in plan(plain)


def test_history_of_a_crowded_key(spark, facts):
    changes = facts.select(
        F.coalesce("k", F.lit(-1)).alias("k"), (F.col("v") % 3).alias("state"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    dim = spark.sql("SELECT 7 AS k, 1L AS state, DATE '2019-01-01' AS valid_from")
    assert tuples(scd2(dim, changes, ["k"], ["state"], "day", group_rows=40)) == tuples(scd2(dim, changes, ["k"], ["state"], "day"))


def test_product_totals_are_made_in_tasks_of_bounded_size(spark, monkeypatch):
    lines = order_lines(spark, "/root/testdata/sf0.001")
    before = {by: tuples(product_totals(lines, by)) for by in ("overall", "daily")}
    monkeypatch.setattr("ordermill.operators.skew.TASK_BYTES", file_bytes(lines) // 9)
    for by, rows in before.items():
        assert re.search(r"hashpartitioning\(.*order_id#\d+L?, \d+\), REPARTITION_BY_NUM", plan(product_totals(lines, by)))
        assert tuples(product_totals(lines, by)) == rows


@pytest.mark.parametrize("name, by", [("dedup_drop_keys", "_task"), ("dedup_recheck", "product_id"), ("daily_sales", "order_id")])
def test_large_groupings_are_made_in_tasks_of_bounded_size(spark, monkeypatch, name, by):
    folder = "/root/testdata/sf0.001"
    before = tuples(QUERIES[name](spark, folder))
    monkeypatch.setattr("ordermill.operators.skew.TASK_BYTES", 1 << 13)
    dealt = QUERIES[name](spark, folder)
    assert re.search(rf"hashpartitioning\(.*{by}#\d+L?, \d+\), REPARTITION_BY_NUM", plan(dealt))
    assert tuples(dealt) == before


def test_dropping_copies_of_one_key_is_shared_by_tasks(spark, tmp_path, monkeypatch):
    spark.range(8000).select((F.col("id") % 1).alias("k")).repartition(8).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    monkeypatch.setattr("ordermill.operators.skew.TASK_BYTES", -(-file_bytes(rows) // 8))
    assert tuples(deduplicate(rows, ["k"], "drop")) == [(0,)]
    assert "_task" in plan(deduplicate(rows, ["k"], "drop"))
