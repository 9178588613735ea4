"""Order lines, dirty lines and nested raw orders, derived from the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import day_of, line_amount
from ..operators.joins import match

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def shown(query: Query) -> Query:
    """The query with dates as ISO text and decimals as doubles, the forms that any two engines
    hand to Python alike. Only the registered queries do this; the operators keep their types."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = query(spark, folder)
        columns: list[Column] = []
        for field in df.schema:
            column = F.col(field.name)
            if isinstance(field.dataType, T.DateType):
                column = column.cast("string").alias(field.name)
            elif isinstance(field.dataType, T.DecimalType):
                column = column.cast("double").alias(field.name)
            columns.append(column)
        return df.select(*columns)

    return run


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        day_of("o_orderdate").alias("purchase_date"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their nation's name as ``country``."""
    nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    customer = table(spark, folder, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return match(customer, nation, "n_nationkey").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), "country", "c_acctbal", "c_mktsegment"
    )


def unpriced_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_linenumber").alias("line_no"),
        day_of("l_shipdate").alias("ship_date"),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Clean order lines: ``order_id, customer_id, purchase_date, product_id, product_name,
    category, quantity, price, line_no, ship_date, line_amount``."""
    lines = match(unpriced_lines(spark, folder), orders(spark, folder), "order_id")
    lines = match(lines, products(spark, folder), "product_id")
    return lines.withColumn("line_amount", line_amount("quantity", "price"))


LINES = """
lines AS (
  SELECT l_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS purchase_date,
         l_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
         l_linenumber AS line_no, CAST(l_shipdate AS DATE) AS ship_date,
         CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2)) AS DECIMAL(18,2)) AS line_amount
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN part ON p_partkey = l_partkey
)"""


def dirty_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The order lines as messy text: padding, decimal commas, blanks, slashes and impossible dates."""
    clean = order_lines(spark, folder)
    order, line = F.col("order_id"), F.col("line_no")
    key = order + line
    day = F.col("purchase_date").cast("string")
    slashed = F.when(order % 5 == 0, F.translate(day, "-", "/")).otherwise(day)
    date_text = F.when(order % 23 == 0, "2023-02-30").otherwise(
        F.concat(F.lit(" "), slashed, F.when(order % 11 == 0, "T00:00").otherwise(" "))
    )
    fraction = F.when(key % 3 == 0, ",00").when(key % 4 == 0, ".6").otherwise(" ")
    quantity_text = F.when(order % 17 == 0, "  ").when(key % 19 == 0, "many").otherwise(
        F.concat(F.col("quantity").cast("string"), fraction)
    )
    decimal_comma = F.translate(F.col("price").cast("string"), ".", ",")
    price_text = F.when(key % 29 == 0, "1,234.50").otherwise(
        F.concat(F.when(key % 13 == 0, "1 ").otherwise(" "), decimal_comma)
    )
    return clean.select(
        F.concat(F.lit(" "), order.cast("string")).alias("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        date_text.alias("purchase_date"),
        F.when(key % 31 == 0, F.lit(None).cast("string")).otherwise(F.col("product_id").cast("string")).alias("product_id"),
        F.concat(F.lit("  "), F.col("product_name"), F.lit(" ")).alias("product_name"),
        quantity_text.alias("quantity"),
        price_text.alias("price"),
    )


DIRTY = LINES + """,
dirty AS (
  SELECT ' ' || order_id AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
         CASE WHEN order_id % 23 = 0 THEN '2023-02-30'
              ELSE ' ' || CASE WHEN order_id % 5 = 0 THEN replace(CAST(purchase_date AS VARCHAR), '-', '/')
                               ELSE CAST(purchase_date AS VARCHAR) END
                   || CASE WHEN order_id % 11 = 0 THEN 'T00:00' ELSE ' ' END END AS purchase_date,
         CASE WHEN (order_id + line_no) % 31 = 0 THEN NULL ELSE CAST(product_id AS VARCHAR) END AS product_id,
         '  ' || product_name || ' ' AS product_name,
         CASE WHEN order_id % 17 = 0 THEN '  '
              WHEN (order_id + line_no) % 19 = 0 THEN 'many'
              WHEN (order_id + line_no) % 3 = 0 THEN quantity || ',00'
              WHEN (order_id + line_no) % 4 = 0 THEN quantity || '.6'
              ELSE quantity || ' ' END AS quantity,
         CASE WHEN (order_id + line_no) % 29 = 0 THEN '1,234.50'
              WHEN (order_id + line_no) % 13 = 0 THEN '1 ' || replace(CAST(price AS VARCHAR), '.', ',')
              ELSE ' ' || replace(CAST(price AS VARCHAR), '.', ',') END AS price
  FROM lines
)"""


def _parsed(source: str, target: str) -> str:
    """SQL for cleansing text lines, written with other means than the operator uses."""
    date_parts = [
        f"lpad(regexp_extract(trim(purchase_date), '^(\\d{{1,4}}){s}(\\d{{1,2}}){s}(\\d{{1,2}})(\\D|$)', 1), 4, '0')"
        f" || '-' || regexp_extract(trim(purchase_date), '^(\\d{{1,4}}){s}(\\d{{1,2}}){s}(\\d{{1,2}})(\\D|$)', 2)"
        f" || '-' || regexp_extract(trim(purchase_date), '^(\\d{{1,4}}){s}(\\d{{1,2}}){s}(\\d{{1,2}})(\\D|$)', 3)"
        for s in ("-", "/")
    ]
    return f"""
{target} AS (
  SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id,
         coalesce(TRY_CAST({date_parts[0]} AS DATE), TRY_CAST({date_parts[1]} AS DATE)) AS purchase_date,
         trim(product_id) AS product_id, trim(product_name) AS product_name,
         CAST(round(TRY_CAST(replace(regexp_replace(quantity, '\\s+', '', 'g'), ',', '.') AS DOUBLE)) AS INTEGER) AS quantity,
         TRY_CAST(replace(regexp_replace(price, '\\s+', '', 'g'), ',', '.') AS DECIMAL(10,2)) AS price
  FROM {source}
)"""


CLEANSED = DIRTY + "," + _parsed("dirty", "cleansed")


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Nested raw orders, made row by row from ``orders``: up to three products each, some orders
    with an empty list or none at all, repeated products, messy numbers and dates."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    day = day_of("o_orderdate").cast("string")
    total = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    texts = table(spark, folder, "orders").select(
        F.concat(F.lit("O"), order.cast("string")).alias("order_id"),
        F.concat(F.lit("C"), customer.cast("string")).alias("customer_id"),
        F.when(order % 23 == 0, "2023-02-30").when(order % 5 == 0, F.translate(day, "-", "/"))
        .otherwise(F.concat(F.lit(" "), day)).alias("purchase_date"),
        F.concat(F.lit("P"), (customer % 997).cast("string")).alias("product"),
        F.concat(F.lit("Q"), (customer % 991).cast("string")).alias("other_product"),
        F.concat(F.lit(" "), "o_orderpriority").alias("name"),
        F.when(order % 41 == 0, "x").otherwise(F.concat((order % 9).cast("string"), F.lit(",00"))).alias("units"),
        F.when(order % 43 == 0, "1,234.50").otherwise(F.translate(total, ".", ",")).alias("price"),
        F.when(order % 29 != 3, (order % 4).cast("int")).alias("size"),
    )

    def item(product: str, digit: str) -> Column:
        quantity = F.concat(F.lit(digit), "units")
        return F.struct(F.col(product).alias("product_id"), "name", quantity.alias("quantity"), "price")

    # A null size gives no list at all.
    items = F.array(item("product", "1"), item("other_product", " "), item("product", "2"))
    return texts.select("order_id", "customer_id", "purchase_date", F.slice(items, F.lit(1), F.col("size")).alias("products"))


RAW_LINES = """
items AS (
  SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderpriority, unnest(range(1, o_orderkey % 4 + 1)) AS i
  FROM orders WHERE o_orderkey % 29 <> 3
),
raw_lines AS (
  SELECT 'O' || o_orderkey AS order_id, 'C' || o_custkey AS customer_id,
         CASE WHEN o_orderkey % 23 = 0 THEN '2023-02-30'
              WHEN o_orderkey % 5 = 0 THEN replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '/')
              ELSE ' ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS purchase_date,
         CASE WHEN i = 2 THEN 'Q' || o_custkey % 991 ELSE 'P' || o_custkey % 997 END AS product_id,
         ' ' || o_orderpriority AS product_name,
         CASE i WHEN 1 THEN '1' WHEN 2 THEN ' ' ELSE '2' END
           || CASE WHEN o_orderkey % 41 = 0 THEN 'x' ELSE o_orderkey % 9 || ',00' END AS quantity,
         CASE WHEN o_orderkey % 43 = 0 THEN '1,234.50'
              ELSE replace(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',') END AS price
  FROM items
)"""

RAW_CLEANSED = RAW_LINES + "," + _parsed("raw_lines", "raw_cleansed")

RAW_SILVER = RAW_CLEANSED + """,
raw_unique AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY order_id, product_id
      ORDER BY purchase_date DESC NULLS LAST, customer_id DESC NULLS LAST, product_name DESC NULLS LAST,
               quantity DESC NULLS LAST, price DESC NULLS LAST) AS rn
    FROM raw_cleansed)
  WHERE rn = 1
),
silver AS (
  SELECT *, CAST(quantity * price AS DECIMAL(18,2)) AS line_amount FROM raw_unique
  WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND purchase_date IS NOT NULL
    AND quantity IS NOT NULL AND price IS NOT NULL
)"""
