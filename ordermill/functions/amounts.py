"""Exact money arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def line_amount(quantity: Column | str, price: Column | str, dtype: str = "decimal(18,2)") -> Column:
    """``quantity * price`` as an exact decimal; null when it does not fit ``dtype``."""
    quantity = F.col(quantity) if isinstance(quantity, str) else quantity
    price = F.col(price) if isinstance(price, str) else price
    return F.try_multiply(quantity.try_cast("decimal(10,0)"), price).try_cast(dtype)


