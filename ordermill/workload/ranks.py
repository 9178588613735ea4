"""Ranks per group, rolling sums, running totals and runs of days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import day_of
from ..operators import islands, ranked, rolling_daily, running_total
from .tables import LINES, order_lines, products, table


def best_units_per_day(spark: SparkSession, folder: str) -> DataFrame:
    units = order_lines(spark, folder).groupBy("purchase_date", "product_id").agg(F.sum("quantity").alias("units"))
    return ranked(units, ["purchase_date"], [("units", "desc"), ("product_id", "asc")], "row_number", 1, "rnk")


def best_revenue_per_day(spark: SparkSession, folder: str) -> DataFrame:
    revenue = order_lines(spark, folder).groupBy("purchase_date", "product_id").agg(F.sum("line_amount").alias("revenue"))
    # A day has at most one row per product.
    bound = products(spark, folder).count()
    return ranked(revenue, ["purchase_date"], [("revenue", "desc")], "dense_rank", 1, group_bound=bound)


def largest_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The three largest orders of each customer, equal ones included."""
    totals = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total")
    )
    return ranked(totals, ["customer_id"], [("total", "desc")], "rank", 3, "rnk")


def largest_1200(spark: SparkSession, folder: str) -> DataFrame:
    """A top longer than Spark cuts groups down for: the 1,200 largest orders of all."""
    totals = table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total"))
    return ranked(totals, [], [("total", "desc"), ("order_id", "asc")], "row_number", 1200, "rnk")


def priority_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """All orders of a customer, densely ranked by priority; many are equal."""
    totals = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("priority"),
    )
    return ranked(totals, ["customer_id"], [("priority", "asc")], "dense_rank", None, "priority_rank")


def rolling_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = order_lines(spark, folder).select("purchase_date", F.col("line_amount").alias("rev"))
    return rolling_daily(lines, "purchase_date", "rev", 2, "rev_2d")


def rolling_days(spark: SparkSession, folder: str) -> DataFrame:
    lines = order_lines(spark, folder).select("ship_date", F.col("line_amount").alias("rev"))
    return rolling_daily(lines, "ship_date", "rev", 7, "rev_7d", contiguous=True)


def spending(spark: SparkSession, folder: str) -> DataFrame:
    """What a customer has spent up to and including each order."""
    amounts = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_id"),
        day_of("o_orderdate").alias("purchase_date"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )
    return running_total(amounts, ["customer_id"], ["purchase_date", "order_id"], "amount")


def active_runs(spark: SparkSession, folder: str) -> DataFrame:
    days = table(spark, folder, "events").select("user_id", day_of("ts").alias("day"))
    return islands(days, "user_id", "day")


QUERIES = {
    "largest_1200_orders": largest_1200,
    "top_product_per_day_units": best_units_per_day,
    "dense_rank_daily": best_revenue_per_day,
    "rank_top3": largest_orders,
    "dense_rank_all": priority_ranks,
    "rolling_2row_revenue": rolling_rows,
    "rolling_7day_revenue": rolling_days,
    "running_total": spending,
    "islands_user_days": active_runs,
}

SQL = {
    "largest_1200_orders": """SELECT order_id, total, CAST(rnk AS INTEGER) AS rnk FROM (
  SELECT o_orderkey AS order_id, o_totalprice AS total, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rnk FROM orders) WHERE rnk <= 1200""",
    "top_product_per_day_units": f"""WITH {LINES},
u AS (SELECT purchase_date, product_id, CAST(sum(quantity) AS BIGINT) AS units FROM lines GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY purchase_date ORDER BY units DESC, product_id) AS INTEGER) AS rnk FROM u)
SELECT * REPLACE (CAST(purchase_date AS VARCHAR) AS purchase_date) FROM r WHERE rnk = 1""",
    "dense_rank_daily": f"""WITH {LINES},
v AS (SELECT purchase_date, product_id, sum(line_amount) AS revenue FROM lines GROUP BY 1, 2),
r AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY purchase_date ORDER BY revenue DESC) AS INTEGER) AS rank FROM v)
SELECT CAST(purchase_date AS VARCHAR) AS purchase_date, product_id, CAST(revenue AS DOUBLE) AS revenue, rank
FROM r WHERE rank <= 1""",
    "rank_top3": """SELECT customer_id, order_id, total, rnk FROM (
  SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_totalprice AS total,
         CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS INTEGER) AS rnk FROM orders)
WHERE rnk <= 3""",
    "dense_rank_all": """SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_orderpriority AS priority,
  dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS priority_rank FROM orders""",
    "rolling_2row_revenue": f"""WITH {LINES},
d AS (SELECT purchase_date, sum(line_amount) AS rev FROM lines GROUP BY 1)
SELECT CAST(purchase_date AS VARCHAR) AS purchase_date, CAST(rev AS DOUBLE) AS rev,
  CAST(sum(rev) OVER (ORDER BY purchase_date ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS DOUBLE) AS rev_2d FROM d""",
    "rolling_7day_revenue": f"""WITH {LINES},
d AS (SELECT ship_date, sum(line_amount) AS rev FROM lines GROUP BY 1),
c AS (SELECT CAST(unnest(generate_series(min(ship_date), max(ship_date), INTERVAL 1 DAY)) AS DATE) AS ship_date FROM d),
f AS (SELECT ship_date, coalesce(rev, 0) AS rev FROM c LEFT JOIN d USING (ship_date))
SELECT CAST(ship_date AS VARCHAR) AS ship_date, CAST(rev AS DOUBLE) AS rev,
  CAST(sum(rev) OVER (ORDER BY ship_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) AS rev_7d FROM f""",
    "running_total": """SELECT o_custkey AS customer_id, o_orderkey AS order_id,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS purchase_date, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS run_total FROM orders""",
    "islands_user_days": """WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
f AS (SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY user_id ORDER BY day) = 1 THEN 0 ELSE 1 END AS opens FROM d),
g AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY day) AS island FROM f)
SELECT user_id, CAST(min(day) AS VARCHAR) AS start_day, CAST(max(day) AS VARCHAR) AS end_day, count(*) AS days
FROM g GROUP BY user_id, island""",
}
