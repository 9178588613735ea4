import decimal

from pyspark.sql import functions as F

from ordermill.operators import (
    duplicates, freshness, grain, join_counts, json_fields, non_positive, null_or_blank, null_safe_totals, pivot, profile,
    reconcile, table_shape, total_mismatches, unpivot, with_customer_total,
)
from ordermill.sinks import save_table
from tests.conftest import tuples

D = decimal.Decimal


def _lines(spark):
    return spark.sql("SELECT * FROM VALUES ('o1', 'p1', 1, 5.0BD), ('o1', 'p1', 0, null), ('o2', ' ', -1, 0.0BD), ('o3', null, null, 1.0BD) "
                     "AS t(order_id, product_id, quantity, price)")


def test_duplicates_and_grain(spark):
    assert tuples(duplicates(_lines(spark))) == [("o1", "p1", 2)]
    assert tuple(grain(_lines(spark), ["order_id", "product_id"]).first()) == (2, 1)
    assert tuple(grain(_lines(spark).limit(0), ["order_id"]).first()) == (0, 0)


def test_profile(spark):
    df = _lines(spark).withColumn("tags", F.create_map(F.lit("a"), F.lit(1)))
    assert tuples(profile(df)) == sorted([
        ("order_id", 4, 0.0, "o1", "o3"), ("product_id", 4, 0.25, " ", "p1"), ("quantity", 4, 0.25, "-1", "1"),
        ("price", 4, 0.25, "0.0", "5.0"), ("tags", 4, 0.0, None, None)], key=repr)
    assert profile(df.limit(0), ["quantity"]).first().null_ratio is None


def test_counts(spark):
    df = _lines(spark)
    assert tuple(null_safe_totals(df, "price", "quantity").first()) == (D("6.0"), 4, 3)
    assert tuple(null_safe_totals(df.limit(0), "price", "quantity").first()) == (0, 0, 0)
    assert tuples(null_or_blank(df, ["product_id", "quantity"])) == [("product_id", 2, 4), ("quantity", 1, 4)]
    assert tuples(non_positive(df)) == [("price<=0", 1), ("quantity<=0", 2)]


def test_freshness(spark):
    df = spark.sql("SELECT * FROM VALUES (DATE '2025-01-01'), (DATE '2025-02-01'), (null) AS t(d)")
    assert freshness(df, "d", "2025-02-08").first()[0] == 7


def test_join_counts(spark):
    left = spark.sql("SELECT * FROM VALUES (1), (1), (2), (3), (null) AS t(k)")
    right = spark.sql("SELECT * FROM VALUES (1, 'a'), (1, 'b'), (2, 'c'), (null, 'd') AS t(k, x)")
    assert tuple(join_counts(left, right, "k").first()) == (5, left.join(right, "k").count(), 2)
    assert tuple(join_counts(left.limit(0), right, "k").first()) == (0, 0, 0)


def test_reconcile(silver):
    before = silver.unionByName(silver.limit(1))
    after = with_customer_total(silver)
    assert dict(tuples(reconcile(before, after))) == {
        "rows_before_dedup": 7, "rows_after_dedup": 6, "null_line_amount_rows": 1, "null_customer_total_rows": 0,
        "sum_of_lines": D("29.30"), "sum_of_customer_totals": D("29.30"), "remaining_duplicate_keys": 0, "customer_total_mismatches": 0}
    wrong = after.withColumn("customer_total_revenue", F.when(F.col("customer_id") == "anna", F.col("customer_total_revenue")))
    assert tuples(total_mismatches(wrong)) == [("ben", None, D("5.00")), ("cleo", None, D("4.30"))]


def test_reshape(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'x', 2), (1, 'y', 3), (1, 'x', 4), (2, 'z', 9) AS t(r, c, v)")
    wide = pivot(df, ["r"], "c", ["x", "y"], "v")
    assert wide.columns == ["r", "x", "y", "other"] and tuples(wide) == [(1, 6, 3, None), (2, None, None, 9)]
    assert tuples(unpivot(wide, ["r"], ["x", "y"])) == [(1, "x", 6), (1, "y", 3), (2, "x", None), (2, "y", None)]
    texts = spark.createDataFrame([('{"k": 5, "s": "a"}',), ("broken",), (None,)], "j string")
    assert tuples(json_fields(texts, "j", "k INT, s STRING"), "k", "s") == [(5, "a"), (None, None), (None, None)]


def test_catalogue_table(spark, silver):
    save_table(silver, "order_lines_test", by="purchase_date")
    count, description = table_shape(spark, "order_lines_test")
    assert count.first().row_count == 6
    assert "# Partition Information" in [r.col_name for r in description.collect()]
    moved = description.repartition(5, F.reverse("col_name"))  # as rows come from several executors
    assert [r.col_name for r in moved.orderBy("position").limit(3).collect()] == silver.drop("purchase_date").columns[:3]
    save_table(silver.limit(1), "order_lines_test")
    assert spark.table("order_lines_test").count() == 1
    spark.sql("DROP TABLE order_lines_test")
