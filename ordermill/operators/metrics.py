"""Revenue, sales and rolling figures over order lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import line_amount
from .joins import match
from .ordered import prefix_sum
from .ranking import ranked
from .skew import GROUP_ROWS, dealt

_BEST_FIRST = (("revenue", "desc"), ("product_id", "asc"), ("product_name", "asc"))


def _product_keys(by: str) -> list[str]:
    extra = {"overall": [], "daily": ["purchase_date"]}
    if by not in extra:
        raise ValueError(f"no such grouping: {by!r}; there are {', '.join(extra)}")
    return [*extra[by], "product_id", "product_name"]


def product_totals(df: DataFrame, by: str = "overall") -> DataFrame:
    """``product_revenue`` in no particular order, for use inside other plans.

    What a product adds up to within each order comes first; products are then summed over their orders, which also counts these.
    Few lines share an order and a product, so the first step makes hardly fewer rows: these are dealt to tasks of a bounded size.
    """
    keys = _product_keys(by)
    within = dealt(df, [*keys, "order_id"]).groupBy(*keys, "order_id").agg(F.sum("line_amount").alias("amount"), F.sum("quantity").alias("units"))
    kinds = dict(within.dtypes)
    return within.groupBy(*keys).agg(
        F.sum("amount").cast(kinds["amount"]).alias("revenue"), F.sum("units").cast(kinds["units"]).alias("total_quantity"),
        F.count("order_id").alias("order_count"),
    )


def product_revenue(df: DataFrame, by: str = "overall") -> DataFrame:
    """Revenue, units and distinct orders per product, or per product and day, best first."""
    return product_totals(df, by).orderBy(F.desc("revenue"))


def top_of_totals(totals: DataFrame, n: int = 10, by: str = "overall") -> DataFrame:
    """The best ``n`` rows, over all or per day, of a ``product_totals`` frame."""
    _product_keys(by)
    return ranked(totals, ["purchase_date"] if by == "daily" else [], _BEST_FIRST, "row_number", n)


def top_products(df: DataFrame, n: int = 10, by: str = "overall") -> DataFrame:
    """The best ``n`` products by revenue, over all or per day; ties go to the smaller id."""
    return top_of_totals(product_totals(df, by), n, by)


def average_order_value(df: DataFrame) -> DataFrame:
    """One row: total revenue, number of orders, revenue per order."""
    totals = df.groupBy("order_id").agg(F.sum("line_amount").alias("order_total")).agg(
        F.sum("order_total").alias("total_revenue"), F.count(F.lit(1)).alias("order_count")
    )
    average = F.try_divide("total_revenue", "order_count").try_cast("decimal(18,2)")
    return totals.withColumn("average_order_value", average)


def sales_lines(orders: DataFrame, products: DataFrame, dtype: str = "decimal(12,2)") -> DataFrame:
    """Orders with their product's columns and ``line_amount`` = ``qty * price``."""
    priced = match(orders, products, "product_id").withColumn("price", F.col("price").try_cast("decimal(10,2)"))
    return priced.withColumn("line_amount", line_amount("qty", "price", dtype))


def daily_totals(lines: DataFrame) -> DataFrame:
    """Gross sales, distinct orders and units per ``order_date``; lines are dealt by date and order to tasks of a bounded size."""
    return dealt(lines, ["order_date", "order_id"]).groupBy("order_date").agg(
        F.sum("line_amount").alias("gross_sales"),
        F.count_distinct("order_id").alias("orders"),
        F.sum("qty").alias("units"),
    )


def daily_sales(orders: DataFrame, products: DataFrame) -> DataFrame:
    return daily_totals(sales_lines(orders, products))


def category_revenue(lines: DataFrame) -> DataFrame:
    return (
        lines.groupBy("category").agg(F.round(F.sum("line_amount"), 2).alias("revenue"))
        .orderBy(F.desc("revenue"))
    )


def orders_by_country(orders: DataFrame, customers: DataFrame) -> DataFrame:
    joined = match(orders, customers.select("customer_id", "country"), "customer_id")
    return joined.groupBy("country").agg(F.count_distinct("order_id").alias("orders"))


def rolling_daily(
    lines: DataFrame, day: str, value: str, rows: int = 2, out: str = "rolling", contiguous: bool = False
) -> DataFrame:
    """Sum of ``value`` per day, and over this and the ``rows - 1`` rows before it.

    The ordered window sees one row per day, however many lines there are. With ``contiguous``
    days without lines count as zero and lines without a day are left out, so ``rows`` means
    calendar days.
    """
    if not isinstance(lines.schema[day].dataType, T.DateType):
        raise ValueError(f"{day} must be a date")
    daily = lines.groupBy(day).agg(F.sum(value).alias(value))
    if contiguous:
        calendar = daily.agg(F.min(day).alias("first"), F.max(day).alias("last")).select(
            F.explode(F.sequence("first", "last")).alias(day)
        )
        daily = calendar.join(daily, day, "left").withColumn(
            value, F.coalesce(F.col(value), F.lit(0).cast(daily.schema[value].dataType))
        )
    window = Window.orderBy(day).rowsBetween(1 - rows, 0)
    return daily.withColumn(out, F.sum(value).over(window))


#: Calendar days of a slice: a group's days are summed slice by slice.
SLICE_DAYS = 366


def rolling_days(
    lines: DataFrame, group: Sequence[str], day: str, value: str, days: int = 7, out: str = "rolling", slice_days: int = SLICE_DAYS
) -> DataFrame:
    """``group``, ``day``, the sum of ``value`` on that day, and ``out``: the sum over the ``days`` calendar days that end with it.

    One row per group and day that has lines, as ``RANGE BETWEEN days - 1 PRECEDING AND CURRENT ROW`` gives. Days are added up
    first, combined before the shuffle. A group's days are then cut into slices of the calendar, and each slice also gets the
    last ``days - 1`` days before it, its halo, so slices of one group are summed by different tasks. Sums of decimals and whole
    numbers do not depend on the slices; those of doubles may, in their last digits. Lines without a day are a day of their own.
    """
    if not isinstance(lines.schema[day].dataType, T.DateType):
        raise ValueError(f"{day} must be a date")
    width = max(days, slice_days)  # so a day is in the halo of one slice at most
    daily = lines.groupBy(*group, day).agg(F.sum(value).alias(value))
    number = F.unix_date(day)
    slice_of = lambda n: F.floor(n / width).cast("int")
    seen_by = F.sequence(slice_of(number), slice_of(number + days - 1))
    sliced = daily.withColumn("_number", number).withColumn("_slice", F.explode_outer(seen_by))
    window = Window.partitionBy(*group, "_slice").orderBy("_number").rangeBetween(1 - days, Window.currentRow)
    summed = sliced.withColumn(out, F.sum(value).over(window))
    return summed.where(F.col("_slice").eqNullSafe(slice_of(F.col("_number")))).drop("_number", "_slice")


def running_total(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    value: str,
    out: str = "run_total",
    group_rows: int = GROUP_ROWS,
    group_bound: int | None = None,
) -> DataFrame:
    """Sum of ``value`` in the group from its first row by ``order`` to this one."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    return prefix_sum(df, group, columns, F.col(value), out, group_rows, group_bound)


def line_counts(df: DataFrame, key: str = "order_id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("line_count"))
