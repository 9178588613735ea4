from .history import islands, scd2, upsert
from .joins import match
from .lines import (
    cleanse, deduplicate, explode_lines, split_valid, tag_errors, with_customer_total, with_line_amount,
)
from .metrics import (
    average_order_value, category_revenue, daily_sales, daily_totals, line_counts, orders_by_country,
    product_revenue, product_totals, rolling_daily, rolling_days, running_total, sales_lines, top_of_totals, top_products,
)
from .ordered import neighbour, prefix_sum, row_numbers
from .quality import (
    duplicates, explode_check, freshness, grain, join_counts, non_positive, null_or_blank,
    null_safe_totals, profile, reconcile, rule_breaks, table_shape, total_mismatches,
)
from .ranking import ranked
from .reshape import json_fields, pivot, unpivot

__all__ = [
    "average_order_value", "category_revenue", "cleanse", "daily_sales", "daily_totals", "deduplicate",
    "duplicates", "explode_check", "explode_lines", "freshness", "grain", "islands",
    "join_counts", "json_fields", "line_counts", "match", "neighbour", "non_positive", "null_or_blank",
    "null_safe_totals", "orders_by_country", "pivot", "prefix_sum", "product_revenue", "product_totals",
    "profile", "ranked", "reconcile", "rolling_daily", "rolling_days", "row_numbers", "rule_breaks", "running_total",
    "sales_lines", "scd2", "split_valid", "table_shape", "tag_errors", "top_of_totals", "top_products",
    "total_mismatches", "unpivot", "upsert", "with_customer_total", "with_line_amount",
]
