from .json_records import read_json_records
from .readers import (
    calendar, ingest_path, read_csv, read_customers_csv, read_orders_csv, read_products_csv,
    read_raw_orders, read_table, register_views,
)

__all__ = [
    "calendar", "ingest_path", "read_csv", "read_customers_csv", "read_json_records", "read_orders_csv",
    "read_products_csv", "read_raw_orders", "read_table", "register_views",
]
