import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from ordermill.operators import (
    average_order_value, category_revenue, daily_sales, islands, orders_by_country, product_revenue, ranked,
    rolling_daily, running_total, sales_lines, top_products,
)
from ordermill.plans import dated_orders
from tests.conftest import tuples

D = decimal.Decimal
DAY = datetime.date


def test_product_revenue(silver):
    overall = product_revenue(silver)
    assert overall.columns == ["product_id", "product_name", "revenue", "total_quantity", "order_count"]
    assert [tuple(r) for r in overall.collect()] == [
        ("cup", "Cup", D("15.00"), 6, 2), ("jar", "Jar", D("11.20"), 4, 2), ("cup", "Blue cup", D("3.10"), 1, 1), ("pan", "Pan", None, 1, 1)]
    daily = product_revenue(silver, "daily")
    assert daily.columns[0] == "purchase_date"
    assert tuples(daily, "product_id", "revenue") == sorted([
        ("cup", D("10.00")), ("jar", D("10.00")), ("cup", D("5.00")), ("pan", None), ("cup", D("3.10")), ("jar", D("1.20"))], key=repr)


@pytest.mark.parametrize("function", [product_revenue, top_products])
def test_unknown_grouping_is_refused(silver, function):
    with pytest.raises(ValueError):
        function(silver, by="weekly")


def test_top_products(silver):
    assert tuples(top_products(silver, 2), "product_id", "product_name", "rank") == [("cup", "Cup", 1), ("jar", "Jar", 2)]
    daily = top_products(silver, 1, "daily")
    assert tuples(daily.select(F.col("purchase_date").cast("string"), "product_id", "revenue", "rank")) == [
        ("2024-07-01", "cup", D("10.00"), 1), ("2024-07-02", "cup", D("5.00"), 1), ("2024-07-04", "cup", D("3.10"), 1)]
    assert dict(daily.dtypes)["rank"] == "int"


def test_top_products_ties_go_to_the_smaller_id(spark):
    rows = [("o", DAY(2025, 1, 1), f"p{n}", "x", 1, D("1.00")) for n in (3, 1, 2)]
    df = spark.createDataFrame(rows, "order_id string, purchase_date date, product_id string, product_name string, quantity int, line_amount decimal(18,2)")
    assert tuples(top_products(df, 2), "product_id", "rank") == [("p1", 1), ("p2", 2)]
    assert tuples(top_products(df, 2, "daily"), "product_id", "rank") == [("p1", 1), ("p2", 2)]


def test_average_order_value(silver):
    out = average_order_value(silver)
    assert out.columns == ["total_revenue", "order_count", "average_order_value"]
    assert dict(out.dtypes)["average_order_value"] == "decimal(18,2)"
    assert tuple(out.first()) == (D("29.30"), 3, D("9.77"))
    assert tuple(average_order_value(silver.limit(0)).first()) == (None, 0, None)
    unpriced = silver.withColumn("line_amount", F.when(F.col("order_id") != "s3", F.col("line_amount")))
    assert tuple(average_order_value(unpriced).first()) == (D("25.00"), 3, D("8.33"))


@pytest.fixture
def sales(spark):
    orders = spark.sql("""SELECT * FROM VALUES (1, TIMESTAMP '2025-03-21T10:15:00Z', 1, 10, 2), (2, TIMESTAMP '2025-03-21T23:59:59Z', 1, 12, 1),
        (3, TIMESTAMP '2025-03-22T00:00:00Z', 2, 14, 1), (3, TIMESTAMP '2025-03-22T01:00:00Z', 2, 10, 1),
        (4, TIMESTAMP '2025-03-23T01:00:00Z', 9, 99, 1) AS t(order_id, order_ts, customer_id, product_id, qty)""")
    products = spark.sql("SELECT * FROM VALUES (10, 's', 'Apparel', 19.99), (12, 'm', 'Home', 7.5), (14, 'n', 'Home', 29.0) AS t(product_id, sku, category, price)")
    customers = spark.sql("SELECT * FROM VALUES (1, 'BG'), (2, 'US'), (3, 'DE') AS t(customer_id, country)")
    return dated_orders(orders), products, customers


def test_daily_sales(sales):
    orders, products, _ = sales
    assert tuples(daily_sales(orders, products).select(F.col("order_date").cast("string"), "gross_sales", "orders", "units")) == [
        ("2025-03-21", D("47.48"), 2, 3), ("2025-03-22", D("48.99"), 1, 2)]


def test_category_and_country(sales):
    orders, products, customers = sales
    lines = sales_lines(orders, products)
    assert dict(lines.dtypes)["line_amount"] == "decimal(12,2)"
    assert [tuple(r) for r in category_revenue(lines).collect()] == [("Apparel", D("59.97")), ("Home", D("36.50"))]
    assert tuples(orders_by_country(orders, customers)) == [("BG", 2), ("US", 1)]


def test_plain_product(spark):
    df = spark.createDataFrame([(2, 3.5), (1, 10.0)], "qty int, price double")
    assert [r[0] for r in df.select(F.col("qty") * F.col("price")).collect()] == [7.0, 10.0]


def test_rolling_rows_and_days(spark):
    df = spark.sql("SELECT * FROM VALUES (DATE '2025-01-01', 1.0BD), (DATE '2025-01-01', 2.0BD), (DATE '2025-01-02', 4.0BD), "
                   "(DATE '2025-01-04', 8.0BD) AS t(day, rev)").select("day", F.col("rev").cast("decimal(18,2)").alias("rev"))
    rows = rolling_daily(df, "day", "rev", 2, "r")
    assert tuples(rows.select(F.dayofmonth("day"), F.col("r").cast("int"))) == [(1, 3), (2, 7), (4, 12)]
    days = rolling_daily(df, "day", "rev", 2, "r", contiguous=True)
    assert tuples(days.select(F.dayofmonth("day"), F.col("r").cast("int"))) == [(1, 3), (2, 7), (3, 4), (4, 8)]


def test_running_total(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1, 5), ('a', 2, null), ('a', 3, 7), ('b', 1, null), ('b', 2, 2) AS t(g, d, v)")
    assert tuples(running_total(df, ["g"], ["d"], "v"), "g", "d", "run_total") == [
        ("a", 1, 5), ("a", 2, 5), ("a", 3, 12), ("b", 1, None), ("b", 2, 2)]


def test_rank_kinds(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 9), ('a', 9), ('a', 5), ('a', 1) AS t(g, v)")

    def numbers(how):
        return sorted(r.rank for r in ranked(df, ["g"], [("v", "desc")], how, 3).collect())

    assert (numbers("row_number"), numbers("rank"), numbers("dense_rank")) == ([1, 2, 3], [1, 1, 3], [1, 1, 2, 3])


def test_islands(spark):
    df = spark.sql("SELECT * FROM VALUES (1, DATE '2025-01-01'), (1, DATE '2025-01-01'), (1, DATE '2025-01-02'), (1, DATE '2025-01-05'), "
                   "(2, DATE '2024-12-31'), (2, DATE '2025-01-01'), (2, null) AS t(u, d)")
    assert tuples(islands(df, "u", "d").select("u", F.col("start_day").cast("string"), F.col("end_day").cast("string"), "days")) == [
        (1, "2025-01-01", "2025-01-02", 2), (1, "2025-01-05", "2025-01-05", 1), (2, "2024-12-31", "2025-01-01", 2)]
