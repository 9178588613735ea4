"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import day_of
from ..operators import (
    cleanse, deduplicate, duplicates, freshness, grain, join_counts, match, non_positive, null_or_blank,
    null_safe_totals, profile, reconcile, total_mismatches, with_customer_total, with_line_amount,
)
from ..operators.skew import dealt
from ..schemas import ORDER_KEY
from .tables import CLEANSED, LINES, customers, dirty_lines, order_lines, orders, products, table, unpriced_lines

AS_OF = "2024-03-01"


def repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    return duplicates(unpriced_lines(spark, folder))


def repeated_after_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Duplicate keys before and after duplicate removal."""
    lines = unpriced_lines(spark, folder)
    latest = deduplicate(lines, order_by=[F.col("ship_date").desc_nulls_last()])
    # No key is crowded any more, so rows may be dealt by it: else the count of keys would share its tasks with the sort before.
    latest = dealt(latest.select(*ORDER_KEY), ORDER_KEY)
    counted = [
        duplicates(frame).agg(F.count(F.lit(1)).alias("duplicate_keys")).withColumn("stage", F.lit(stage))
        for stage, frame in (("before", lines), ("after", latest))
    ]
    return counted[0].unionByName(counted[1])


def line_grain(spark: SparkSession, folder: str) -> DataFrame:
    return grain(unpriced_lines(spark, folder), ["order_id", "line_no"])


def order_profile(spark: SparkSession, folder: str) -> DataFrame:
    columns = orders(spark, folder).withColumn("late_order", F.when(F.col("purchase_date") >= "1998-01-01", F.col("order_id")))
    return profile(columns)


def debt_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals over dirty lines, where amounts and quantities may be missing."""
    lines = with_line_amount(cleanse(dirty_lines(spark, folder)))
    return null_safe_totals(lines, "line_amount", "quantity")


def event_age(spark: SparkSession, folder: str) -> DataFrame:
    return freshness(table(spark, folder, "events").select(day_of("ts").alias("day")), "day", AS_OF)


def blank_counts(spark: SparkSession, folder: str) -> DataFrame:
    return null_or_blank(dirty_lines(spark, folder), ["product_id", "quantity", "price", "customer_id"])


def rule_break_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Lines whose corrected quantity, or reduced price, is not positive."""
    lines = order_lines(spark, folder).select(
        (F.col("quantity") - F.col("line_no") * 2).alias("quantity"), (F.col("price") - 1000).alias("price")
    )
    return non_positive(lines)


def _silver(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    lines = order_lines(spark, folder).select(
        "order_id", "product_id", "customer_id", "ship_date", "line_no", "quantity", "line_amount"
    )
    unique = deduplicate(lines, order_by=[F.col("ship_date").desc_nulls_last()])
    return lines, with_customer_total(unique)


def reconciled(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile(*_silver(spark, folder))


def mismatched_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Customers whose total before duplicate removal differs from the one after it."""
    lines, unique = _silver(spark, folder)
    stale = lines.groupBy("customer_id").agg(F.sum("line_amount").alias("stale_total"))
    checked = match(unique.drop("customer_total_revenue"), stale, "customer_id", "left")
    return total_mismatches(checked, "stale_total")


def customer_join_counts(spark: SparkSession, folder: str) -> DataFrame:
    rich = customers(spark, folder).where(F.col("c_acctbal") > 5000)
    return join_counts(orders(spark, folder), rich, "customer_id")


def part_join_counts(spark: SparkSession, folder: str) -> DataFrame:
    return join_counts(unpriced_lines(spark, folder), products(spark, folder), "product_id")


QUERIES = {
    "duplicate_keys": repeated_keys,
    "dedup_recheck": repeated_after_dedup,
    "grain_check": line_grain,
    "column_profile": order_profile,
    "null_safe_agg": debt_totals,
    "freshness": event_age,
    "null_blank_check": blank_counts,
    "nonpositive_check": rule_break_counts,
    "totals_reconcile": reconciled,
    "total_mismatches": mismatched_totals,
    "join_count_check": customer_join_counts,
    "join_count_complete": part_join_counts,
}

_UNIQUE = """
u AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, product_id
    ORDER BY ship_date DESC NULLS LAST, customer_id DESC, line_no DESC, quantity DESC, line_amount DESC) AS rn FROM lines)
  WHERE rn = 1)"""

SQL = {
    "duplicate_keys": """SELECT l_orderkey AS order_id, l_partkey AS product_id, count(*) AS row_count
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "dedup_recheck": """SELECT 'before' AS stage, count(*) AS duplicate_keys FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1)
UNION ALL SELECT 'after', 0""",
    "grain_check": """WITH c AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS BIGINT) AS unique_groups,
       CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS dup_groups FROM c""",
    "column_profile": """WITH o AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS t, o_orderkey AS v, 'order_id' AS column_name FROM orders UNION ALL
  SELECT CAST(o_custkey AS VARCHAR), o_custkey, 'customer_id' FROM orders UNION ALL
  SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR), datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)), 'purchase_date' FROM orders UNION ALL
  SELECT CASE WHEN o_orderdate >= DATE '1998-01-01' THEN CAST(o_orderkey AS VARCHAR) END,
         CASE WHEN o_orderdate >= DATE '1998-01-01' THEN o_orderkey END, 'late_order' FROM orders)
SELECT column_name, count(*) AS row_cnt,
       CAST(sum(CASE WHEN t IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS null_ratio,
       arg_min(t, v) AS min_val, arg_max(t, v) AS max_val FROM o GROUP BY 1""",
    "null_safe_agg": f"""WITH {CLEANSED}
SELECT CAST(coalesce(sum(CAST(quantity * price AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_amount, count(*) AS row_cnt,
       count(quantity) AS non_null_cnt FROM cleansed""",
    "freshness": f"""SELECT CAST(DATE '{AS_OF}' - max(CAST(ts AS DATE)) AS INTEGER) AS days_since_last_event FROM events""",
    "null_blank_check": f"""WITH {CLEANSED},
t AS (SELECT 'product_id' AS column_name, product_id AS v FROM dirty UNION ALL SELECT 'quantity', quantity FROM dirty
      UNION ALL SELECT 'price', price FROM dirty UNION ALL SELECT 'customer_id', customer_id FROM dirty)
SELECT column_name, CAST(sum(CASE WHEN v IS NULL OR trim(v) = '' THEN 1 ELSE 0 END) AS BIGINT) AS bad_rows,
       count(*) AS total_rows FROM t GROUP BY 1""",
    "nonpositive_check": f"""WITH {LINES}
SELECT 'quantity<=0' AS rule, count(*) AS rows FROM lines WHERE quantity - line_no * 2 <= 0
UNION ALL SELECT 'price<=0', count(*) FROM lines WHERE price - 1000 <= 0""",
    "totals_reconcile": f"""WITH {LINES}, {_UNIQUE}
SELECT 'rows_before_dedup' AS "check", CAST(count(*) AS DOUBLE) AS value FROM lines
UNION ALL SELECT 'rows_after_dedup', count(*) FROM u
UNION ALL SELECT 'null_line_amount_rows', count(*) FROM u WHERE line_amount IS NULL
UNION ALL SELECT 'null_customer_total_rows', 0
UNION ALL SELECT 'sum_of_lines', CAST(sum(line_amount) AS DOUBLE) FROM u
UNION ALL SELECT 'sum_of_customer_totals', CAST(sum(line_amount) AS DOUBLE) FROM u
UNION ALL SELECT 'remaining_duplicate_keys', 0
UNION ALL SELECT 'customer_total_mismatches', 0""",
    "total_mismatches": f"""WITH {LINES}, {_UNIQUE},
a AS (SELECT customer_id, sum(line_amount) AS stale_total FROM lines GROUP BY 1),
b AS (SELECT customer_id, sum(line_amount) AS grp_total FROM u GROUP BY 1)
SELECT customer_id, CAST(stale_total AS DOUBLE) AS stale_total, CAST(grp_total AS DOUBLE) AS grp_total
FROM a JOIN b USING (customer_id) WHERE stale_total <> grp_total""",
    "join_count_check": """WITH r AS (SELECT c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal > 5000)
SELECT (SELECT count(*) FROM orders) AS rows_before,
       (SELECT count(*) FROM orders JOIN r ON c_custkey = o_custkey) AS rows_after,
       (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM r)) AS unmatched_rows""",
    "join_count_complete": """SELECT (SELECT count(*) FROM lineitem) AS rows_before,
       (SELECT count(*) FROM lineitem JOIN part ON p_partkey = l_partkey) AS rows_after,
       (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)) AS unmatched_rows""",
}
