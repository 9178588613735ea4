import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from ordermill.operators import (
    cleanse, deduplicate, explode_check, explode_lines, split_valid, tag_errors, with_customer_total, with_line_amount,
)
from tests.conftest import tuples

D = decimal.Decimal


def test_explode_drops_orders_without_products(raw):
    lines = explode_lines(raw)
    assert lines.columns == ["order_id", "customer_id", "purchase_date", "product_id", "product_name", "quantity", "price"]
    assert tuples(lines, "order_id", "product_id") == [("R-10", "cup"), ("R-10", "cup"), ("R-10", "jar"), ("R-12", "jar")]
    assert tuple(explode_check(raw, lines).first()) == (4, 4)


def test_marked_records_give_one_row_with_the_mark_alone(raw):
    marked = raw.withColumn("mark", F.when(F.col("order_id") == "R-13", "text"))
    lines = explode_lines(marked, keep="mark")
    assert tuples(lines.where("mark is not null"), "order_id", "product_id", "mark") == [("R-13", None, "text")]
    assert lines.where("mark is null").count() == 4


def test_cleanse_types_and_values(raw):
    out = cleanse(explode_lines(raw))
    types = dict(out.dtypes)
    assert (types["purchase_date"], types["quantity"], types["price"]) == ("date", "int", "decimal(10,2)")
    assert tuples(out, "order_id", "product_id", "product_name", "quantity", "price", "purchase_date") == [
        ("R-10", "cup", "Cup, blue", 12, D("3.05"), datetime.date(2024, 7, 3)), ("R-10", "cup", "Cup, blue", None, D("3.05"), datetime.date(2024, 7, 3)),
        ("R-10", "jar", "", -2, None, datetime.date(2024, 7, 3)), ("R-12", "jar", "Jar", 0, D("0.50"), None)]


def test_cleanse_keeps_bad_rows_and_blank_ids(spark):
    df = spark.sql("SELECT ' ' AS order_id, 'c' AS customer_id, 'x' AS purchase_date, '' AS product_id, "
                   "'n' AS product_name, 'two' AS quantity, '' AS price")
    assert tuple(cleanse(df).first()) == ("", "c", None, "", "n", None, None)
    assert tuple(cleanse(df, blank_ids_are_null=True).first()) == (None, "c", None, None, "n", None, None)


def _versions(spark):
    """Two keys with several versions (one undated), one key seen once, and two rows without an order."""
    return spark.sql("""SELECT * FROM VALUES
        ('A-7', 'x', DATE '2024-02-29', 'mug', 'Mug', 3, 4.20BD), ('A-7', 'y', DATE '2024-03-02', 'mug', 'Mug', 2, 4.20BD),
        ('A-7', 'x', DATE '2024-03-01', 'mug', 'Mug', 1, 4.25BD), ('A-7', 'x', null, 'mug', 'Mug', 8, 4.20BD),
        ('A-7', 'x', null, 'pen', 'Pen', 1, 0.90BD), ('B-1', 'z', DATE '2023-12-31', 'pen', 'Pen', 5, 0.90BD),
        (null, 'z', DATE '2024-01-05', 'mug', 'Mug', 1, 4.20BD), (null, 'z', DATE '2024-01-04', 'mug', 'Mug', 6, 4.20BD)
        AS t(order_id, customer_id, purchase_date, product_id, product_name, quantity, price)""")


def test_latest_row_per_key_is_kept(spark):
    out = deduplicate(_versions(spark))
    assert tuples(out.select("order_id", "product_id", F.col("purchase_date").cast("string"))) == [
        ("A-7", "mug", "2024-03-02"), ("A-7", "pen", None), ("B-1", "pen", "2023-12-31"), (None, "mug", "2024-01-05")]


def test_ties_do_not_depend_on_row_order(spark):
    rows = [("o", "p", datetime.date(2025, 1, 1), n) for n in range(50)]
    kept = {
        tuple(deduplicate(spark.createDataFrame(order, "order_id string, product_id string, purchase_date date, n int")
                          .repartition(parts)).first())
        for order, parts in ((rows, 1), (rows[::-1], 3), (rows[25:] + rows[:25], 4))
    }
    assert kept == {("o", "p", datetime.date(2025, 1, 1), 49)}


def test_dedup_strategies(spark):
    assert deduplicate(_versions(spark), strategy="drop").count() == 4
    with pytest.raises(ValueError):
        deduplicate(_versions(spark), strategy="latest")


def test_amount_and_customer_total(spark):
    df = spark.sql("""SELECT * FROM VALUES ('x', 'k1', 'mug', 4, 2.25BD), ('x', 'k1', 'pen', 0, 9.99BD), ('x', 'k2', 'mug', -1, 0.50BD),
        (null, 'k3', 'mug', 2, 0.05BD), (null, 'k4', 'pen', null, 3.00BD), ('y', 'k5', 'pen', 7, null), ('z', 'k6', 'mug', 1, 99999999.99BD)
        AS t(customer_id, order_id, product_id, quantity, price)""")
    for group_rows in (10, 1):
        out = with_customer_total(with_line_amount(df), group_rows=group_rows)
        assert dict(out.dtypes)["line_amount"] == "decimal(18,2)"
        assert dict(out.dtypes)["customer_total_revenue"] == "decimal(28,2)"
        assert tuples(out, "order_id", "product_id", "line_amount", "customer_total_revenue") == [
            ("k1", "mug", D("9.00"), D("8.50")), ("k1", "pen", D("0.00"), D("8.50")), ("k2", "mug", D("-0.50"), D("8.50")),
            ("k3", "mug", D("0.10"), D("0.10")), ("k4", "pen", None, D("0.10")), ("k5", "pen", None, None),
            ("k6", "mug", D("99999999.99"), D("99999999.99"))]


def test_valid_and_bad_rows(spark):
    df = spark.sql("SELECT * FROM VALUES ('o1', 'p1', DATE '2025-01-01', 1, 1.0BD), ('o2', null, null, 1, 1.0BD) "
                   "AS t(order_id, product_id, purchase_date, quantity, price)")
    valid, bad = split_valid(df)
    assert tuples(valid, "order_id") == [("o1",)] and valid.columns == df.columns
    assert tuples(bad, "order_id", "error_reason") == [("o2", "product_id=NULL, purchase_date=NULL")]
    assert tuples(tag_errors(df), "order_id", "error_reason") == [
        ("o1", None), ("o2", "product_id=NULL, purchase_date=NULL")]
