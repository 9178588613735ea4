"""The daily sales job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import utc_date
from ..operators.metrics import daily_sales
from ..sinks import write_one_file_each
from ..sources import read_orders_csv, read_products_csv


def dated_orders(orders: DataFrame) -> DataFrame:
    """Orders with ``order_date``, the UTC day of ``order_ts``."""
    return orders.withColumn("order_date", utc_date("order_ts"))


def run_daily_sales(spark: SparkSession, orders_path: str, products_path: str, out_path: str) -> None:
    """CSV orders and products to daily sales, one file per ``order_date``; the output is replaced."""
    orders = dated_orders(read_orders_csv(spark, orders_path))
    products = read_products_csv(spark, products_path)
    write_one_file_each(daily_sales(orders, products), out_path, "order_date", incremental=False)
