"""Explicit schemas, so that no source needs an inference pass over its data."""

from pyspark.sql import types as T

PRODUCT_ITEM = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("quantity", T.StringType()),
    T.StructField("price", T.StringType()),
])

CORRUPT = "_corrupt_record"

RAW_ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("purchase_date", T.StringType()),
    T.StructField("products", T.ArrayType(PRODUCT_ITEM)),
])

ORDERS_CSV = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("order_ts", T.TimestampType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("qty", T.IntegerType()),
])

CUSTOMERS_CSV = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("signup_date", T.DateType()),
])

PRODUCTS_CSV = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("sku", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DecimalType(10, 2)),
])

ORDER_KEY = ("order_id", "product_id")
CRITICAL = ("order_id", "product_id", "purchase_date", "quantity", "price")
