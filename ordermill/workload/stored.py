"""Tables that follow their sources load by load: versioned tables, stored history, gold states, clustered and pruned files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import day_of, line_amount
from ..operators import match, rolling_days
from ..operators.fingerprint import differing_groups
from ..operators.joins import filtered_match, on_chosen
from ..operators.quality import table_shape
from ..plans import silver_to_gold
from ..plans.dimension import apply_changes, history_table, read_history
from ..sinks import VersionedTable, save_table, write_partitions
from ..sinks.clustering import write_clustered
from ..sources import calendar, read_table
from ..workspace import kept, stable, staged, staging
from .reshaping import _priorities
from .tables import LINES, order_lines, orders, products, table, unpriced_lines

DATES = ("1995-01-02", "1996-02-29", "1996-12-31", "1998-08-02")


def merged_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by year after a merge that moves the pending ones on by a year and deletes some open ones."""
    source = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"), F.year(day_of("o_orderdate")).alias("year"))
    moved = source.where("status = 'P'").withColumns({"status": F.lit("F"), "year": F.col("year") + 1})
    gone = source.where("status = 'O' AND order_id % 7 = 0").withColumn("status", F.lit("gone"))
    with staging(spark) as root:
        stored = VersionedTable(spark, f"{root}/orders", "year")
        stored.replace(source)
        stored.merge(moved.unionByName(gone), ["order_id"], [F.desc("year")], F.col("status") == "gone")
        return stable(stored.read().groupBy("year", "status").agg(F.count(F.lit(1)).alias("orders")))


def stored_history(spark: SparkSession, folder: str) -> DataFrame:
    """The customers' history after four loads, of which the last comes twice."""
    customers, changes = _priorities(spark, folder)
    with staging(spark) as root:
        changes = staged(changes, f"{root}/changes")  # not made anew for each load
        loads = [customers.withColumnRenamed("valid_from", "seen").select(*changes.columns)]
        loads += [changes.where(F.col("seen").between(*span)) for span in (("1900-01-01", "1993-12-31"), ("1994-01-01", "1996-06-30"), ("1996-07-01", "2100-01-01"))]
        stored = history_table(spark, f"{root}/customers")
        for load in [*loads, loads[-1]]:
            apply_changes(stored, load, ["customer_id"], ["priority"], "seen", buckets=8)
        return kept(read_history(stored), "history")


def _two_loads(spark: SparkSession, folder: str, root: str) -> None:
    """Silver and gold by quarter after two loads, the second of which brings everything since 1995 anew, and comes twice."""
    # joined with the orders last, so that lines of an order lie together
    lines = match(match(unpriced_lines(spark, folder), products(spark, folder), "product_id"), orders(spark, folder), "order_id")
    lines = lines.withColumn("line_amount", line_amount("quantity", "price")).select(
        "order_id", "customer_id", F.trunc("purchase_date", "quarter").alias("purchase_date"), "product_id", "product_name", "quantity", "line_amount")
    # some lines of every fifth order come a quarter later, so that orders spread over dates
    lines = lines.withColumn("purchase_date", F.when(F.col("order_id") % 5 == 0, F.add_months("purchase_date", (F.col("product_id") % 2 * 3).cast("int"))).otherwise(F.col("purchase_date")))
    write_partitions(lines, f"{root}/silver/order_lines", "purchase_date", sort_by=["order_id"], gather=False)
    # what comes anew is made once, from silver, whose files are gathered by date
    later = read_table(spark, f"{root}/silver/order_lines").where("purchase_date >= '1995-01-01' AND order_id % 3 > 0")
    write_partitions(later.withColumn("line_amount", (F.col("line_amount") * 2).cast("decimal(18,2)")), f"{root}/later", "purchase_date", sort_by=["order_id"], gather=False)
    later = read_table(spark, f"{root}/later")
    for load in (None, later, later):
        changed = None if load is None else [row[0] for row in load.select("purchase_date").distinct().collect()]
        if load is not None:
            write_partitions(load, f"{root}/silver/order_lines", "purchase_date", sort_by=["order_id"], gather=False)
        silver_to_gold(spark, f"{root}/silver", f"{root}/gold", changed_dates=changed, snapshot=False)


def customer_revenue_history(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue and lines of every customer over all loads, kept up without reading what did not change."""
    with staging(spark) as root:
        _two_loads(spark, folder, root)
        return kept(read_table(spark, f"{root}/gold/customer_revenue"), "customers")


def overall_from_states(spark: SparkSession, folder: str) -> DataFrame:
    """Overall product revenue and distinct orders after the same loads, from daily states alone."""
    with staging(spark) as root:
        _two_loads(spark, folder, root)
        return kept(read_table(spark, f"{root}/gold/product_revenue_overall"), "products")


def product_rolling_days(spark: SparkSession, folder: str) -> DataFrame:
    lines = order_lines(spark, folder).select("product_id", "ship_date", F.col("line_amount").alias("rev"))
    return rolling_days(lines, ["product_id"], "ship_date", "rev", 7, "rev_7d")


def changed_years(spark: SparkSession, folder: str) -> DataFrame:
    """Years whose orders differ from a copy with one changed value, one swap between two rows, one row twice and one less."""
    source = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("total"), F.year(day_of("o_orderdate")).alias("year"))
    first = source.groupBy("year").agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))
    copy = match(source, first, "year")
    at_low, at_high = F.col("o_orderkey") == F.col("low"), F.col("o_orderkey") == F.col("high")
    copy = copy.withColumn("total", F.when((F.col("year") == 1993) & at_low, (F.col("total") + 1).cast("decimal(18,2)")).otherwise(F.col("total")))
    # 1994: the customers of two orders change places, so all sums and counts of the columns stay the same
    pair = source.alias("s").join(first.where("year = 1994").alias("f"), F.col("s.o_orderkey").isin(F.col("f.low"), F.col("f.high"))).agg(F.sum("s.o_custkey").alias("both"))
    copy = copy.join(F.broadcast(pair), F.lit(True), "left")
    copy = copy.withColumn("o_custkey", F.when((F.col("year") == 1994) & (at_low | at_high), F.col("both") - F.col("o_custkey")).otherwise(F.col("o_custkey")))
    copy = copy.unionByName(copy.where((F.col("year") == 1995) & at_low)).where(~((F.col("year") == 1996) & at_high))
    return differing_groups(source, copy.select(*source.columns), "year")


def clustered_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders from files clustered by customer and date, found by either."""
    with staging(spark) as root:
        write_clustered(orders(spark, folder), f"{root}/orders", ["customer_id", "purchase_date"], files=16)
        stored = read_table(spark, f"{root}/orders")
        return kept(stored.where("customer_id BETWEEN 100 AND 199 OR purchase_date BETWEEN DATE'1995-03-01' AND DATE'1995-03-31'"), "orders")


def filtered_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Units of the products of one brand, whose lines pass a Bloom filter before the join."""
    brand = match(products(spark, folder), table(spark, folder, "part").where("p_brand = 'Brand#23'").select(F.col("p_partkey").alias("product_id")), "product_id", "left_semi")
    lines = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"))
    joined = filtered_match(lines, brand.select("product_id", "product_name"), "product_id", broadcast_keys=0, bits=1 << 22)
    return joined.groupBy("product_id", "product_name").agg(F.sum("quantity").alias("units"))


def pruned_months(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue in the months that have few orders: silver is partitioned by month, and only the chosen months are read."""
    silver = order_lines(spark, folder).select(F.trunc("purchase_date", "month").alias("month"), "line_amount")
    months = orders(spark, folder).groupBy(F.trunc("purchase_date", "month").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    with staging(spark) as root:
        write_partitions(silver, f"{root}/silver", "month")
        months.coalesce(1).write.parquet(f"{root}/months")
        return stable(on_chosen(read_table(spark, f"{root}/silver"), read_table(spark, f"{root}/months").where("n % 3 = 0").select("month"), "month")
                      .groupBy("month").agg(F.sum("line_amount").alias("revenue")))


def revenue_on_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Daily product revenue of listed dates, as a limited gold run publishes it."""
    lines = order_lines(spark, folder).where(F.col("purchase_date").cast("string").isin(*DATES))
    with staging(spark) as root:
        write_partitions(lines.select("order_id", "customer_id", "purchase_date", "product_id", "product_name", "quantity", "line_amount"), f"{root}/silver/order_lines", "purchase_date")
        silver_to_gold(spark, f"{root}/silver", f"{root}/first")  # so that the states are there
        silver_to_gold(spark, f"{root}/silver", f"{root}/first", changed_dates=DATES[:2])
        found = read_table(spark, f"{root}/first/product_revenue")
        return kept(found.where(F.col("purchase_date").cast("string").isin(*DATES[:2])), "daily")


def shape_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a catalogue table, and its columns and types as described."""
    with staging(spark) as root:
        name = f"shape_{root.rsplit('-', 1)[-1]}"
        source = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", day_of("o_orderdate").alias("day"))
        save_table(source, name, path=f"{root}/{name}")
        try:
            rows, described = table_shape(spark, name)
            columns = described.orderBy("position").limit(3).select(F.concat_ws(" ", "col_name", "data_type").alias("what"), F.lit(None).cast("bigint").alias("n"))
            return stable(columns.unionByName(rows.select(F.lit("rows").alias("what"), F.col("row_count").alias("n"))))
        finally:
            spark.sql(f"DROP TABLE {name}")


def catalogue_table(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per status from a catalogue table partitioned by it, created, replaced and dropped."""
    with staging(spark) as root:
        name = f"orders_{root.rsplit('-', 1)[-1]}"
        source = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
        try:
            save_table(source.limit(0), name, by="status", path=f"{root}/{name}")
            save_table(source, name, by="status", path=f"{root}/{name}")
            return stable(spark.sql(f"SELECT status, count(*) AS orders FROM {name} WHERE status <> 'P' GROUP BY status"))
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def days_without_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Every day from the first order to the last, with its orders."""
    days = orders(spark, folder).groupBy("purchase_date").agg(F.count(F.lit(1)).alias("n"))
    first, last = days.agg(F.min("purchase_date"), F.max("purchase_date")).first()
    every = calendar(spark, first, last) if first else days.select("purchase_date").limit(0)
    return every.toDF("purchase_date").join(days, "purchase_date", "left").select("purchase_date", F.coalesce("n", F.lit(0)).alias("orders"))


QUERIES = {
    "versioned_merge": merged_versions,
    "scd2_stored": stored_history,
    "customer_revenue_history": customer_revenue_history,
    "overall_from_states": overall_from_states,
    "rolling_7day_per_product": product_rolling_days,
    "content_differences": changed_years,
    "clustered_sink": clustered_orders,
    "filtered_join": filtered_lines,
    "pruned_partitions": pruned_months,
    "revenue_on_dates": revenue_on_dates,
    "table_shape": shape_of_orders,
    "catalogue_table": catalogue_table,
    "calendar_days": days_without_orders,
}

_LOADED = f"""WITH {LINES},
shifted AS (SELECT * EXCLUDE (purchase_date), CAST(CASE WHEN order_id % 5 = 0 THEN date_trunc('quarter', purchase_date) + to_months(CAST(product_id % 2 * 3 AS INTEGER))
  ELSE date_trunc('quarter', purchase_date) END AS DATE) AS purchase_date FROM lines),
later AS (SELECT * FROM shifted WHERE purchase_date >= DATE '1995-01-01' AND order_id % 3 > 0),
silver AS (SELECT customer_id, product_id, product_name, order_id, quantity, line_amount FROM shifted WHERE purchase_date NOT IN (SELECT purchase_date FROM later)
  UNION ALL SELECT customer_id, product_id, product_name, order_id, quantity, 2 * line_amount FROM later)"""

SQL = {
    "versioned_merge": """SELECT CAST(CASE WHEN o_orderstatus = 'P' THEN year(o_orderdate) + 1 ELSE year(o_orderdate) END AS INTEGER) AS year,
  CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS status, count(*) AS orders
FROM orders WHERE o_orderstatus <> 'O' OR o_orderkey % 7 <> 0 GROUP BY 1, 2""",
    "scd2_stored": """WITH v AS (
  SELECT c_custkey AS customer_id, 'NONE' AS priority, DATE '1900-01-01' AS valid_from FROM customer UNION ALL
  SELECT o_custkey, min(o_orderpriority), CAST(o_orderdate AS DATE) FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)),
c AS (SELECT *, lag(priority) OVER (PARTITION BY customer_id ORDER BY valid_from) AS previous FROM v),
k AS (SELECT * FROM c WHERE previous IS NULL OR previous <> priority),
d AS (SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS valid_to FROM k)
SELECT customer_id, priority, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
       valid_to IS NULL AS is_current FROM d""",
    "customer_revenue_history": f"""{_LOADED}
SELECT customer_id, CAST(sum(line_amount) AS DOUBLE) AS customer_total_revenue, count(*) AS lines FROM silver GROUP BY customer_id""",
    "overall_from_states": f"""{_LOADED}
SELECT product_id, product_name, CAST(sum(line_amount) AS DOUBLE) AS revenue, CAST(sum(quantity) AS BIGINT) AS total_quantity,
       count(DISTINCT order_id) AS order_count FROM silver GROUP BY 1, 2""",
    "rolling_7day_per_product": f"""WITH {LINES},
d AS (SELECT product_id, ship_date, sum(line_amount) AS rev FROM lines GROUP BY 1, 2)
SELECT product_id, CAST(ship_date AS VARCHAR) AS ship_date, CAST(rev AS DOUBLE) AS rev,
  CAST(sum(rev) OVER (PARTITION BY product_id ORDER BY ship_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS DOUBLE) AS rev_7d FROM d""",
    "content_differences": """WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders GROUP BY 1)
SELECT year, n AS rows_one, CASE year WHEN 1995 THEN n + 1 WHEN 1996 THEN n - 1 ELSE n END AS rows_two FROM y
WHERE year IN (1993, 1995, 1996) OR year = 1994 AND (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderkey IN (low, high)) = 2""",
    "clustered_sink": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS purchase_date FROM orders
WHERE o_custkey BETWEEN 100 AND 199 OR CAST(o_orderdate AS DATE) BETWEEN DATE '1995-03-01' AND DATE '1995-03-31'""",
    "filtered_join": """SELECT l_partkey AS product_id, p_name AS product_name, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS units
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_brand = 'Brand#23' GROUP BY 1, 2""",
    "pruned_partitions": f"""WITH {LINES},
m AS (SELECT CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS month FROM orders GROUP BY 1 HAVING count(*) % 3 = 0)
SELECT CAST(month AS VARCHAR) AS month, CAST(sum(line_amount) AS DOUBLE) AS revenue FROM lines JOIN m ON month = CAST(date_trunc('month', purchase_date) AS DATE) GROUP BY 1""",
    "revenue_on_dates": f"""WITH {LINES}
SELECT product_id, product_name, CAST(sum(line_amount) AS DOUBLE) AS revenue, CAST(sum(quantity) AS BIGINT) AS total_quantity, count(DISTINCT order_id) AS order_count,
  CAST(purchase_date AS VARCHAR) AS purchase_date FROM lines WHERE purchase_date IN (DATE '{DATES[0]}', DATE '{DATES[1]}') GROUP BY 1, 2, purchase_date""",
    "table_shape": """SELECT 'o_orderkey bigint' AS what, CAST(NULL AS BIGINT) AS n UNION ALL SELECT 'o_orderstatus string', NULL UNION ALL SELECT 'day date', NULL
UNION ALL SELECT 'rows', count(*) FROM orders""",
    "catalogue_table": """SELECT o_orderstatus AS status, count(*) AS orders FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""",
    "calendar_days": """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day FROM orders),
c AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d)
SELECT CAST(c.day AS VARCHAR) AS purchase_date, count(d.day) AS orders FROM c LEFT JOIN d ON c.day = d.day GROUP BY 1""",
}
