"""Exploding, cleansing, duplicate removal, quarantine, amounts and customer totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import (
    cleanse, deduplicate, explode_check, explode_lines, split_valid, tag_errors, with_customer_total,
    with_line_amount,
)
from ..schemas import ORDER_KEY
from .tables import CLEANSED, LINES, RAW_LINES, dirty_lines, order_lines, raw_orders

_REASON = """concat_ws(', ', CASE WHEN order_id IS NULL THEN 'order_id=NULL' END,
    CASE WHEN product_id IS NULL THEN 'product_id=NULL' END,
    CASE WHEN purchase_date IS NULL THEN 'purchase_date=NULL' END,
    CASE WHEN quantity IS NULL THEN 'quantity=NULL' END,
    CASE WHEN price IS NULL THEN 'price=NULL' END)"""

_SHOWN = """order_id, customer_id, CAST(purchase_date AS VARCHAR) AS purchase_date, product_id, product_name,
       quantity, CAST(price AS DOUBLE) AS price"""


def exploded(spark: SparkSession, folder: str) -> DataFrame:
    return explode_lines(raw_orders(spark, folder))


def explode_counts(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_orders(spark, folder)
    return explode_check(raw, explode_lines(raw))


def cleansed(spark: SparkSession, folder: str) -> DataFrame:
    return cleanse(dirty_lines(spark, folder))


def quarantined(spark: SparkSession, folder: str) -> DataFrame:
    return split_valid(cleansed(spark, folder))[1]


def valid(spark: SparkSession, folder: str) -> DataFrame:
    return split_valid(cleansed(spark, folder))[0]


def error_reasons(spark: SparkSession, folder: str) -> DataFrame:
    tagged = tag_errors(cleansed(spark, folder))
    reason = F.coalesce("error_reason", F.lit("valid"))
    return tagged.groupBy(reason.alias("error_reason")).agg(F.count(F.lit(1)).alias("line_count"))


def _shipped(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("order_id", "product_id", "ship_date", "line_no", "customer_id", "quantity", "price", "line_amount")
    return order_lines(spark, folder).select(*columns)


def latest_lines(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicate(_shipped(spark, folder), order_by=[F.col("ship_date").desc_nulls_last()])


def any_lines(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicate(_shipped(spark, folder), strategy="drop").select(*ORDER_KEY)


def amounts(spark: SparkSession, folder: str) -> DataFrame:
    lines = order_lines(spark, folder).drop("line_amount")
    return with_line_amount(lines).select("order_id", "product_id", "line_no", "quantity", "price", "line_amount")


def customer_totals(spark: SparkSession, folder: str) -> DataFrame:
    lines = order_lines(spark, folder).select("customer_id", "order_id", "product_id", "line_no", "line_amount")
    return with_customer_total(lines)


def lines_by_text(spark: SparkSession, folder: str) -> DataFrame:
    """Complete lines found by a predicate given as SQL text."""
    text = "order_id IS NOT NULL AND quantity IS NOT NULL AND price IS NOT NULL AND quantity > 45"
    return cleansed(spark, folder).where(text).select("order_id", "product_id", "quantity", "price")


QUERIES = {
    "explode_lines": exploded,
    "explode_count_check": explode_counts,
    "cleanse_and_cast": cleansed,
    "quarantine_bad": quarantined,
    "valid_lines": valid,
    "error_reasons": error_reasons,
    "dedup_prefer_latest": latest_lines,
    "dedup_drop_keys": any_lines,
    "line_amount": amounts,
    "customer_total_revenue": customer_totals,
    "sql_text_predicate": lines_by_text,
}

SQL = {
    "explode_lines": f"WITH {RAW_LINES} SELECT * FROM raw_lines",
    "explode_count_check": f"""WITH {RAW_LINES}
SELECT (SELECT sum(CASE WHEN o_orderkey % 29 = 3 THEN 0 ELSE o_orderkey % 4 END)
        FROM orders)::BIGINT AS expected_lines,
       (SELECT count(*) FROM raw_lines) AS actual_lines""",
    "cleanse_and_cast": f"WITH {CLEANSED} SELECT {_SHOWN} FROM cleansed",
    "quarantine_bad": f"""WITH {CLEANSED}
SELECT {_SHOWN}, {_REASON} AS error_reason FROM cleansed WHERE {_REASON} <> ''""",
    "valid_lines": f"""WITH {CLEANSED}
SELECT {_SHOWN} FROM cleansed
WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND purchase_date IS NOT NULL
  AND quantity IS NOT NULL AND price IS NOT NULL""",
    "error_reasons": f"""WITH {CLEANSED}
SELECT coalesce(nullif({_REASON}, ''), 'valid') AS error_reason, count(*) AS line_count FROM cleansed GROUP BY 1""",
    "dedup_prefer_latest": f"""WITH {LINES}
SELECT order_id, product_id, CAST(ship_date AS VARCHAR) AS ship_date, line_no, customer_id, quantity,
       CAST(price AS DOUBLE) AS price, CAST(line_amount AS DOUBLE) AS line_amount
FROM (SELECT *, row_number() OVER (PARTITION BY order_id, product_id
        ORDER BY ship_date DESC NULLS LAST, line_no DESC, customer_id DESC, quantity DESC, price DESC) AS rn FROM lines)
WHERE rn = 1""",
    "dedup_drop_keys": f"WITH {LINES} SELECT DISTINCT order_id, product_id FROM lines",
    "line_amount": f"""WITH {LINES}
SELECT order_id, product_id, line_no, quantity, CAST(price AS DOUBLE) AS price,
       CAST(line_amount AS DOUBLE) AS line_amount FROM lines""",
    "customer_total_revenue": f"""WITH {LINES}
SELECT customer_id, order_id, product_id, line_no, CAST(line_amount AS DOUBLE) AS line_amount,
       CAST(CAST(sum(line_amount) OVER (PARTITION BY customer_id) AS DECIMAL(28,2)) AS DOUBLE) AS customer_total_revenue
FROM lines""",
    "sql_text_predicate": f"""WITH {CLEANSED}
SELECT order_id, product_id, quantity, CAST(price AS DOUBLE) AS price FROM cleansed
WHERE order_id IS NOT NULL AND quantity > 45 AND price IS NOT NULL""",
}
