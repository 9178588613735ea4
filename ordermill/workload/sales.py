"""Revenue, order value, daily sales, and the joins of sales with customers and products."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import (
    average_order_value, category_revenue, daily_sales, daily_totals, line_counts, match, orders_by_country,
    product_revenue, sales_lines, top_products,
)
from ..sources import register_views
from .tables import LINES, customers, order_lines, orders, products, table, unpriced_lines

TOP_N = 10


def revenue_overall(spark: SparkSession, folder: str) -> DataFrame:
    return product_revenue(order_lines(spark, folder), "overall")


def revenue_daily(spark: SparkSession, folder: str) -> DataFrame:
    return product_revenue(order_lines(spark, folder), "daily")


def top_overall(spark: SparkSession, folder: str) -> DataFrame:
    return top_products(order_lines(spark, folder), TOP_N, "overall")


def top_daily(spark: SparkSession, folder: str) -> DataFrame:
    return top_products(order_lines(spark, folder), 3, "daily")


def order_value(spark: SparkSession, folder: str) -> DataFrame:
    return average_order_value(order_lines(spark, folder))


def _sold(spark: SparkSession, folder: str) -> DataFrame:
    """Lines in the form of the flat sales files: one product and quantity per row, with a day."""
    lines = unpriced_lines(spark, folder).select("order_id", "product_id", F.col("quantity").alias("qty"))
    dated = orders(spark, folder).withColumnRenamed("purchase_date", "order_date")
    return match(lines, dated, "order_id")


def daily(spark: SparkSession, folder: str) -> DataFrame:
    return daily_sales(_sold(spark, folder), products(spark, folder).select("product_id", "price"))


def by_category(spark: SparkSession, folder: str) -> DataFrame:
    return category_revenue(
        sales_lines(_sold(spark, folder), products(spark, folder).select("product_id", "category", "price"))
    )


def by_country(spark: SparkSession, folder: str) -> DataFrame:
    return orders_by_country(orders(spark, folder), customers(spark, folder))


def by_date_and_country(spark: SparkSession, folder: str) -> DataFrame:
    """A three-way join as SQL text over temporary views."""
    register_views(
        sales_facts=_sold(spark, folder),
        sales_customers=customers(spark, folder).select("customer_id", "country"),
        sales_products=products(spark, folder).select("product_id", "price"),
    )
    return spark.sql("""
        SELECT f.order_date, c.country, SUM(f.qty * p.price) AS revenue
        FROM sales_facts f
        JOIN sales_customers c USING (customer_id)
        JOIN sales_products p USING (product_id)
        GROUP BY f.order_date, c.country
        ORDER BY f.order_date, revenue DESC""")


def sales_with_customer(spark: SparkSession, folder: str) -> DataFrame:
    return match(orders(spark, folder), customers(spark, folder).select("customer_id", "name", "country"), "customer_id")


def country_customers(spark: SparkSession, folder: str) -> DataFrame:
    return customers(spark, folder).where(F.col("country") == "NATION_7").select("customer_id", "country")


def idle_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers without an urgent order."""
    urgent = table(spark, folder, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    urgent = urgent.select(F.col("o_custkey").alias("customer_id"))
    return match(customers(spark, folder).select("customer_id", "name"), urgent, "customer_id", "left_anti")


def period_with_customer(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of a period with their customer's attributes, where the customer is in debt."""
    first, last = datetime.date(1995, 1, 1), datetime.date(1996, 12, 31)
    facts = orders(spark, folder).where(F.col("purchase_date").between(first, last))
    dim = customers(spark, folder).where(F.col("c_acctbal") < 0).select("customer_id", "name", "country")
    return match(facts, dim, "customer_id", "left")


def order_size(spark: SparkSession, folder: str) -> DataFrame:
    return line_counts(unpriced_lines(spark, folder))


def size_class(spark: SparkSession, folder: str) -> DataFrame:
    """A conditional value, and what it adds up to."""
    lines = order_lines(spark, folder)
    size = F.when(F.col("quantity") >= 40, "large").when(F.col("quantity") >= 15, "medium").otherwise("small")
    return lines.groupBy(size.alias("size_class")).agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("line_amount").alias("revenue")
    )


def overall_totals(spark: SparkSession, folder: str) -> DataFrame:
    return order_lines(spark, folder).agg(
        F.sum("line_amount").alias("revenue"), F.count(F.lit(1)).alias("line_count")
    )


def sale_days(spark: SparkSession, folder: str) -> DataFrame:
    return orders(spark, folder).select("purchase_date").where("purchase_date IS NOT NULL").distinct()


def daily_by_date(spark: SparkSession, folder: str) -> DataFrame:
    lines = sales_lines(_sold(spark, folder), products(spark, folder).select("product_id", "price"))
    return daily_totals(lines).orderBy("order_date")


def named_statuses(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per status, under names that are literal rows; a status without a name stays."""
    names = spark.createDataFrame([("F", "finished"), ("O", "open"), ("X", "unused")], "status string, name string")
    counts = table(spark, folder, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("orders"))
    return match(counts, names, "status", "left")


def first_of_days(spark: SparkSession, folder: str) -> DataFrame:
    """The first order of all by date and id."""
    return orders(spark, folder).orderBy("purchase_date", "order_id").limit(1)


QUERIES = {
    "literal_lookup": named_statuses,
    "first_row": first_of_days,
    "product_revenue_overall": revenue_overall,
    "product_revenue_daily": revenue_daily,
    "top_products_overall": top_overall,
    "top_products_daily": top_daily,
    "average_order_value": order_value,
    "daily_sales": daily,
    "daily_sales_sorted": daily_by_date,
    "category_revenue": by_category,
    "orders_by_country": by_country,
    "revenue_by_date_country": by_date_and_country,
    "orders_with_customer": sales_with_customer,
    "filtered_customers": country_customers,
    "customers_without_orders": idle_customers,
    "fact_left_dim": period_with_customer,
    "lines_per_order": order_size,
    "size_classes": size_class,
    "global_totals": overall_totals,
    "distinct_dates": sale_days,
}

_REVENUE = """SELECT {day} product_id, product_name, sum(line_amount) AS revenue,
       CAST(sum(quantity) AS BIGINT) AS total_quantity, count(DISTINCT order_id) AS order_count
FROM lines GROUP BY ALL"""
_OVERALL = _REVENUE.format(day="")
_DAILY = _REVENUE.format(day="purchase_date,")

_CUSTOMERS = """customers AS (
  SELECT c_custkey AS customer_id, c_name AS name, n_name AS country, c_acctbal
  FROM customer JOIN nation ON n_nationkey = c_nationkey)"""

_DAILY_SALES = f"""WITH {LINES}
SELECT CAST(purchase_date AS VARCHAR) AS order_date, CAST(sum(line_amount) AS DOUBLE) AS gross_sales,
       count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units
FROM lines GROUP BY purchase_date"""

SQL = {
    "literal_lookup": """SELECT o_orderstatus AS status, count(*) AS orders, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS name FROM orders GROUP BY 1""",
    "first_row": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS purchase_date FROM orders
ORDER BY CAST(o_orderdate AS DATE), o_orderkey LIMIT 1""",
    "product_revenue_overall": f"WITH {LINES}, r AS ({_OVERALL}) SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM r",
    "product_revenue_daily": f"""WITH {LINES}, r AS ({_DAILY})
SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue, CAST(purchase_date AS VARCHAR) AS purchase_date) FROM r""",
    "top_products_overall": f"""WITH {LINES}, r AS ({_OVERALL}), t AS (
  SELECT *, CAST(row_number() OVER (ORDER BY revenue DESC NULLS LAST, product_id, product_name) AS INTEGER) AS rank FROM r)
SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM t WHERE rank <= {TOP_N}""",
    "top_products_daily": f"""WITH {LINES}, r AS ({_DAILY}), t AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY purchase_date
    ORDER BY revenue DESC NULLS LAST, product_id, product_name) AS INTEGER) AS rank FROM r)
SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue, CAST(purchase_date AS VARCHAR) AS purchase_date)
FROM t WHERE rank <= 3""",
    "average_order_value": f"""WITH {LINES}, o AS (SELECT order_id, sum(line_amount) AS total FROM lines GROUP BY 1)
SELECT CAST(sum(total) AS DOUBLE) AS total_revenue, count(*) AS order_count,
       round(CAST(sum(total) AS DOUBLE) / count(*), 2) AS average_order_value FROM o""",
    "daily_sales": _DAILY_SALES,
    "daily_sales_sorted": _DAILY_SALES + " ORDER BY 1",
    "category_revenue": f"""WITH {LINES}
SELECT category, CAST(round(sum(line_amount), 2) AS DOUBLE) AS revenue FROM lines GROUP BY 1 ORDER BY 2 DESC""",
    "orders_by_country": f"""WITH {_CUSTOMERS}
SELECT country, count(DISTINCT o_orderkey) AS orders FROM orders JOIN customers ON customer_id = o_custkey GROUP BY 1""",
    "revenue_by_date_country": f"""WITH {LINES}, {_CUSTOMERS}
SELECT CAST(purchase_date AS VARCHAR) AS order_date, country, CAST(sum(quantity * price) AS DOUBLE) AS revenue
FROM lines JOIN customers USING (customer_id) GROUP BY purchase_date, country""",
    "orders_with_customer": f"""WITH {_CUSTOMERS}
SELECT o_orderkey AS order_id, customer_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS purchase_date, name, country
FROM orders JOIN customers ON customer_id = o_custkey""",
    "filtered_customers": f"WITH {_CUSTOMERS} SELECT customer_id, country FROM customers WHERE country = 'NATION_7'",
    "customers_without_orders": """SELECT c_custkey AS customer_id, c_name AS name FROM customer
JOIN nation ON n_nationkey = c_nationkey
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""",
    "fact_left_dim": f"""WITH {_CUSTOMERS},
f AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS purchase_date FROM orders
      WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'),
d AS (SELECT customer_id, name, country FROM customers WHERE c_acctbal < 0)
SELECT f.order_id, f.customer_id, CAST(f.purchase_date AS VARCHAR) AS purchase_date, d.name, d.country
FROM f LEFT JOIN d ON f.customer_id = d.customer_id""",
    "lines_per_order": "SELECT l_orderkey AS order_id, count(*) AS line_count FROM lineitem GROUP BY 1",
    "size_classes": f"""WITH {LINES}
SELECT CASE WHEN quantity >= 40 THEN 'large' WHEN quantity >= 15 THEN 'medium' ELSE 'small' END AS size_class,
       count(*) AS line_count, CAST(sum(line_amount) AS DOUBLE) AS revenue FROM lines GROUP BY 1""",
    "global_totals": f"WITH {LINES} SELECT CAST(sum(line_amount) AS DOUBLE) AS revenue, count(*) AS line_count FROM lines",
    "distinct_dates": "SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS purchase_date FROM orders",
}
