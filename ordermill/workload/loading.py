"""Whole jobs over files: written to the shared folder, read back, and removed again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import day_of
from ..operators import average_order_value, match
from ..plans import raw_to_silver, run_daily_sales, silver_to_gold
from ..sinks import upsert_partitions, write_partitions, write_snapshot
from ..sources import read_raw_orders, read_table
from ..workspace import kept, stable, staging
from .tables import LINES, RAW_SILVER, order_lines, orders, products, raw_orders, table, unpriced_lines

DAY = "2025-09-25"


def array_records(spark: SparkSession, folder: str) -> DataFrame:
    """The raw orders from JSON arrays of many records per file, which several tasks read: records and their products."""
    rows = raw_orders(spark, folder)
    number = spark.sparkContext.defaultParallelism
    records = rows.select(F.pmod(F.xxhash64("order_id"), F.lit(number)).alias("part"), F.lit(1).alias("place"), F.concat(F.lit(",\n "), F.to_json(F.struct(*rows.columns))).alias("value"))
    # A file's brackets are rows of their own; the first comes with an empty record, so that commas may follow.
    ends = spark.range(number).select(F.col("id").alias("part"), F.explode(F.create_map(F.lit(0), F.lit("[{}"), F.lit(2), F.lit("]"))).alias("place", "value"))
    with staging(spark) as root:
        arrays = records.unionByName(ends).repartition(number, "part").sortWithinPartitions("part", "place").select("part", "value")
        arrays.write.partitionBy("part").text(f"{root}/raw")
        read = read_raw_orders(spark, f"{root}/raw/part=*").where("order_id IS NOT NULL OR _corrupt_record IS NOT NULL")
        products = F.coalesce(F.size("products"), F.lit(0))
        units = F.array_join(F.transform("products", lambda x: x["quantity"]), "|")
        return kept(read.select("order_id", "customer_id", "purchase_date", products.alias("products"), units.alias("units"), "_corrupt_record"), "records")


def _loaded(spark: SparkSession, folder: str, root: str, **options):
    """The raw orders as nested JSON files, loaded to silver. Most of the work is creating files, so all cores share it."""
    raw_orders(spark, folder).write.json(f"{root}/raw/ingest_date={DAY}")
    tasks = spark.sparkContext.defaultParallelism
    return raw_to_silver(spark, f"{root}/raw", f"{root}/silver", DAY, multiline=False, tasks=tasks, **options)


def gold_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Nested JSON files to silver to gold, and the product revenue found there."""
    with staging(spark) as root:
        _loaded(spark, folder, root)
        silver_to_gold(spark, f"{root}/silver", f"{root}/gold", snapshot_date=DAY, tasks=spark.sparkContext.defaultParallelism)
        # The result outlives the folder; it holds one row per product, or fewer.
        return stable(read_table(spark, f"{root}/gold/product_revenue_overall"))


def gold_lists(spark: SparkSession, folder: str) -> DataFrame:
    """What the gold job writes next to overall revenue: daily revenue, daily and overall top lists, current and as snapshot."""
    with staging(spark) as root:
        _loaded(spark, folder, root)
        silver_to_gold(spark, f"{root}/silver", f"{root}/gold", snapshot_date=DAY, top_n=5, tasks=spark.sparkContext.defaultParallelism)
        lists = {"product_revenue": ("purchase_date", None), "top_products_daily": ("purchase_date", "rank"),
                 "top_products_current": (None, "rank"), "top_products_snapshot": ("snapshot_date", "rank")}
        rows = [
            read_table(spark, f"{root}/gold/{name}").select(
                F.lit(name).alias("list"), (F.col(day).cast("string") if day else F.lit(None).cast("string")).alias("day"),
                "product_id", "product_name", "revenue", (F.col(rank) if rank else F.lit(None).cast("int")).alias("rank"))
            for name, (day, rank) in lists.items()
        ]
        return kept(reduce(DataFrame.unionByName, rows), "lists")


def silver_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The silver lines as stored, with their customers' totals."""
    with staging(spark) as root:
        _loaded(spark, folder, root)
        return kept(read_table(spark, f"{root}/silver/order_lines"), "lines")


def silver_lines_quarantine_first(spark: SparkSession, folder: str) -> DataFrame:
    """The same when bad rows are set aside before duplicates are removed."""
    with staging(spark) as root:
        _loaded(spark, folder, root, quarantine_first=True)
        return kept(read_table(spark, f"{root}/silver/order_lines"), "lines")


def rejected(spark: SparkSession, folder: str) -> DataFrame:
    """What a load sets aside: rows without a critical value, and records that are no orders."""
    broken = table(spark, folder, "orders").where("o_orderkey % 50 = 1").select(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("order_id"), F.struct(F.col("o_orderkey").alias("n")).alias("products"))
    with staging(spark) as root:
        broken.write.json(f"{root}/raw/ingest_date={DAY}")
        raw_orders(spark, folder).write.mode("append").json(f"{root}/raw/ingest_date={DAY}")
        raw_to_silver(spark, f"{root}/raw", f"{root}/silver", DAY, multiline=False, tasks=spark.sparkContext.defaultParallelism)
        bad = spark.read.parquet(f"{root}/silver/_errors/ingest_date={DAY}")
        return kept(bad.select("order_id", "product_id", "quantity", "error_reason", "corrupt_record"), "rejected")


def gold_figures(spark: SparkSession, folder: str) -> DataFrame:
    """The order figures as the snapshot of one day."""
    with staging(spark) as root:
        write_snapshot(average_order_value(order_lines(spark, folder)), f"{root}/figures", DAY)
        return stable(read_table(spark, f"{root}/figures"))


def csv_sales(spark: SparkSession, folder: str, mark: str = "T12:00:00Z") -> DataFrame:
    """The daily sales job over the lines and products as CSV files."""
    lines = match(unpriced_lines(spark, folder), orders(spark, folder), "order_id")
    facts = lines.select(
        "order_id",
        F.concat(F.col("purchase_date").cast("string"), F.lit(mark)).alias("order_ts"),
        "customer_id", "product_id", F.col("quantity").alias("qty"),
    )
    catalogue = products(spark, folder).select("product_id", F.col("product_name").alias("sku"), "category", "price")
    with staging(spark) as root:
        facts.write.option("header", True).csv(f"{root}/orders")
        catalogue.write.option("header", True).csv(f"{root}/products")
        run_daily_sales(spark, f"{root}/orders", f"{root}/products", f"{root}/out")
        return stable(read_table(spark, f"{root}/out"))


def csv_sales_late(spark: SparkSession, folder: str) -> DataFrame:
    """The same with times near midnight that have no offset: they are UTC in any session."""
    return csv_sales(spark, folder, "T23:30:00")


def replaced_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per year after a second, incremental write of the urgent orders of 1995 alone."""
    source = table(spark, folder, "orders").select(
        F.year(day_of("o_orderdate")).alias("year"), F.col("o_orderkey").alias("order_id"), "o_orderpriority"
    )
    with staging(spark) as root:
        write_partitions(source, f"{root}/orders", "year")
        write_partitions(source.where("year = 1995 AND o_orderpriority = '1-URGENT'"), f"{root}/orders", "year")
        return stable(read_table(spark, f"{root}/orders").groupBy("year").agg(F.count(F.lit(1)).alias("orders")))


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Two snapshots of the orders per status, the second one written twice."""
    counts = table(spark, folder, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("orders"))
    with staging(spark) as root:
        write_snapshot(counts, f"{root}/counts", "2025-01-01")
        write_snapshot(counts.where("status <> 'P'"), f"{root}/counts", "2025-01-02")
        write_snapshot(counts.where("status <> 'P'"), f"{root}/counts", "2025-01-02")
        return stable(read_table(spark, f"{root}/counts"))


def upserted_years(spark: SparkSession, folder: str) -> DataFrame:
    """Orders partitioned by year, after the pending ones move on by one year."""
    source = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
        F.year(day_of("o_orderdate")).alias("year"),
    )
    moved = source.where("status = 'P'").withColumns({"status": F.lit("F"), "year": F.col("year") + 1})
    with staging(spark) as root:
        write_partitions(source, f"{root}/orders", "year")
        upsert_partitions(spark, f"{root}/orders", moved, ["order_id"], [F.desc("year")], "year")
        return stable(read_table(spark, f"{root}/orders").groupBy("year", "status").agg(F.count(F.lit(1)).alias("orders")))


QUERIES = {
    "json_arrays": array_records,
    "silver_gold_roundtrip": gold_revenue,
    "order_kpis_snapshot": gold_figures,
    "csv_daily_sales": csv_sales,
    "csv_daily_sales_late": csv_sales_late,
    "silver_lines": silver_lines,
    "silver_lines_quarantine_first": silver_lines_quarantine_first,
    "gold_lists": gold_lists,
    "quarantine_sink": rejected,
    "incremental_overwrite": replaced_dates,
    "snapshot_rerun": snapshots,
    "partition_upsert": upserted_years,
}

_DAILY_SQL = f"""WITH {LINES}
SELECT CAST(purchase_date AS VARCHAR) AS order_date, CAST(sum(line_amount) AS DOUBLE) AS gross_sales,
       count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units FROM lines GROUP BY purchase_date"""
_STORED_SQL = """SELECT order_id, customer_id, product_id, product_name, quantity, CAST(price AS DOUBLE) AS price,
  CAST(line_amount AS DOUBLE) AS line_amount, CAST(total AS DOUBLE) AS customer_total_revenue, CAST(purchase_date AS VARCHAR) AS purchase_date"""
_VALID_SQL = "order_id IS NOT NULL AND product_id IS NOT NULL AND purchase_date IS NOT NULL AND quantity IS NOT NULL AND price IS NOT NULL"
_LATEST_SQL = """row_number() OVER (PARTITION BY order_id, product_id ORDER BY purchase_date DESC NULLS LAST, customer_id DESC NULLS LAST,
  product_name DESC NULLS LAST, quantity DESC NULLS LAST, price DESC NULLS LAST)"""

SQL = {
    "json_arrays": """SELECT 'O' || o_orderkey AS order_id, 'C' || o_custkey AS customer_id,
  CASE WHEN o_orderkey % 23 = 0 THEN '2023-02-30'
       WHEN o_orderkey % 5 = 0 THEN replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '/')
       ELSE ' ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS purchase_date,
  CAST(CASE WHEN o_orderkey % 29 = 3 THEN 0 ELSE o_orderkey % 4 END AS INTEGER) AS products,
  CASE WHEN o_orderkey % 29 <> 3 THEN array_to_string(list_transform(list_slice(['1', ' ', '2'], 1, o_orderkey % 4),
    lambda d: d || CASE WHEN o_orderkey % 41 = 0 THEN 'x' ELSE o_orderkey % 9 || ',00' END), '|') END AS units,
  NULL AS _corrupt_record FROM orders""",
    "csv_daily_sales_late": _DAILY_SQL,
    "silver_lines": f"""WITH {RAW_SILVER}, t AS (SELECT *, CAST(quantity * price AS DECIMAL(18,2)) AS line_amount FROM raw_unique),
w AS (SELECT *, sum(line_amount) OVER (PARTITION BY customer_id) AS total FROM t)
{_STORED_SQL} FROM w WHERE {_VALID_SQL}""",
    "silver_lines_quarantine_first": f"""WITH {RAW_SILVER}, v AS (SELECT *, {_LATEST_SQL} AS rn FROM raw_cleansed WHERE {_VALID_SQL}),
t AS (SELECT *, CAST(quantity * price AS DECIMAL(18,2)) AS line_amount FROM v WHERE rn = 1),
w AS (SELECT *, sum(line_amount) OVER (PARTITION BY customer_id) AS total FROM t)
{_STORED_SQL} FROM w""",
    "gold_lists": f"""WITH {RAW_SILVER},
d AS (SELECT purchase_date, product_id, product_name, sum(line_amount) AS revenue FROM silver GROUP BY 1, 2, 3),
o AS (SELECT product_id, product_name, sum(line_amount) AS revenue FROM silver GROUP BY 1, 2),
dr AS (SELECT *, row_number() OVER (PARTITION BY purchase_date ORDER BY revenue DESC, product_id, product_name) AS rank FROM d),
r AS (SELECT *, row_number() OVER (ORDER BY revenue DESC, product_id, product_name) AS rank FROM o),
u AS (SELECT 'product_revenue' AS list, CAST(purchase_date AS VARCHAR) AS day, product_id, product_name, revenue, NULL AS rank FROM d
  UNION ALL SELECT 'top_products_daily', CAST(purchase_date AS VARCHAR), product_id, product_name, revenue, rank FROM dr WHERE rank <= 5
  UNION ALL SELECT 'top_products_current', NULL, product_id, product_name, revenue, rank FROM r WHERE rank <= 5
  UNION ALL SELECT 'top_products_snapshot', '{DAY}', product_id, product_name, revenue, rank FROM r WHERE rank <= 5)
SELECT list, day, product_id, product_name, CAST(revenue AS DOUBLE) AS revenue, CAST(rank AS INTEGER) AS rank FROM u""",
    "quarantine_sink": f"""WITH {RAW_SILVER}
SELECT order_id, product_id, quantity, concat_ws(', ', CASE WHEN order_id IS NULL THEN 'order_id=NULL' END, CASE WHEN product_id IS NULL THEN 'product_id=NULL' END,
  CASE WHEN purchase_date IS NULL THEN 'purchase_date=NULL' END, CASE WHEN quantity IS NULL THEN 'quantity=NULL' END,
  CASE WHEN price IS NULL THEN 'price=NULL' END) AS error_reason, NULL AS corrupt_record
FROM raw_unique WHERE NOT ({_VALID_SQL})
UNION ALL SELECT NULL, NULL, NULL, 'corrupt record', '{{"order_id":"O' || o_orderkey || '","products":{{"n":' || o_orderkey || '}}}}' FROM orders WHERE o_orderkey % 50 = 1""",
    "silver_gold_roundtrip": f"""WITH {RAW_SILVER}
SELECT product_id, product_name, CAST(sum(line_amount) AS DOUBLE) AS revenue, CAST(sum(quantity) AS BIGINT) AS total_quantity,
       count(DISTINCT order_id) AS order_count FROM silver GROUP BY 1, 2""",
    "order_kpis_snapshot": f"""WITH {LINES}, o AS (SELECT order_id, sum(line_amount) AS total FROM lines GROUP BY 1)
SELECT CAST(sum(total) AS DOUBLE) AS total_revenue, count(*) AS order_count,
       round(CAST(sum(total) AS DOUBLE) / count(*), 2) AS average_order_value, '{DAY}' AS snapshot_date FROM o""",
    "csv_daily_sales": f"""WITH {LINES}
SELECT CAST(purchase_date AS VARCHAR) AS order_date, CAST(sum(line_amount) AS DOUBLE) AS gross_sales,
       count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units FROM lines GROUP BY purchase_date""",
    "incremental_overwrite": """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders FROM orders
WHERE year(o_orderdate) <> 1995 OR o_orderpriority = '1-URGENT' GROUP BY 1""",
    "snapshot_rerun": """SELECT o_orderstatus AS status, count(*) AS orders, '2025-01-01' AS snapshot_date FROM orders GROUP BY 1
UNION ALL SELECT o_orderstatus, count(*), '2025-01-02' FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""",
    "partition_upsert": """SELECT CAST(CASE WHEN o_orderstatus = 'P' THEN year(o_orderdate) + 1 ELSE year(o_orderdate) END AS INTEGER) AS year,
  CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS status, count(*) AS orders FROM orders GROUP BY 1, 2""",
}
