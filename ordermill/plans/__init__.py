from .medallion import SilverCounts, raw_to_silver, silver_to_gold
from .sales import dated_orders, run_daily_sales

__all__ = ["SilverCounts", "dated_orders", "raw_to_silver", "run_daily_sales", "silver_to_gold"]
