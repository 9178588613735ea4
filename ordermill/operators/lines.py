"""Nested raw orders to clean, unique, priced order lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import blank_to_null, line_amount, parse_date, parse_number
from ..schemas import CRITICAL, ORDER_KEY
from ..workspace import stable
from .joins import match
from .skew import GROUP_ROWS, dealt


def explode_lines(raw: DataFrame, keep: str | None = None) -> DataFrame:
    """One row per product of an order, still text; orders without products give no row.

    ``keep`` names a column that marks records which are no orders: such a record gives one row with only that column.
    """
    order = ["order_id", "customer_id", "purchase_date"]
    products, extra = F.col("products"), []
    if keep is not None:
        none = F.array(F.lit(None).cast(raw.schema["products"].dataType.elementType))
        products, extra = F.when(F.col(keep).isNotNull(), none).otherwise(products), [keep]
    return raw.select(*order, *extra, F.explode(products).alias("item")).select(
        *order,
        "item.product_id",
        F.col("item.name").alias("product_name"),
        "item.quantity",
        "item.price",
        *extra,
    )


def cleanse(
    lines: DataFrame, blank_ids_are_null: bool = False, date_forms: Sequence[str] = ("-", "/")
) -> DataFrame:
    """Trim text; parse ``purchase_date`` (date), ``quantity`` (int) and ``price`` (decimal(10,2)).

    No row is dropped: what does not parse is null. Blank ids stay blank unless
    ``blank_ids_are_null``.
    """
    ids = {"order_id", "product_id"}
    typed: dict[str, Column] = {
        "purchase_date": parse_date("purchase_date", date_forms),
        "quantity": parse_number("quantity", "int"),
        "price": parse_number("price", "decimal(10,2)"),
    }
    for name in ("order_id", "customer_id", "product_id", "product_name"):
        trimmed = F.trim(F.col(name))
        typed[name] = blank_to_null(trimmed) if blank_ids_are_null and name in ids else trimmed
    return lines.withColumns(typed)


def deduplicate(
    df: DataFrame,
    keys: Sequence[str] = ORDER_KEY,
    strategy: str = "prefer_latest",
    order_by: Sequence[Column] | None = None,
    tie_break: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per key.

    ``prefer_latest`` keeps the first row by ``order_by`` (latest ``purchase_date``, nulls last)
    and then ``tie_break`` (all other columns, descending), so the result is always the same.
    ``drop`` keeps any row. In both cases each map task passes on one row per key at most, so a key
    with very many copies stays cheap.
    """
    if strategy == "drop":
        # Dealt by key and task, so that the copies of one key are still met by many tasks, none of which gets more when the input grows.
        spread = dealt(df.withColumn("_task", F.spark_partition_id()), [*keys, "_task"])
        return spread.drop("_task").dropDuplicates(list(keys))
    if strategy != "prefer_latest":
        raise ValueError("strategy must be 'prefer_latest' or 'drop'")
    if order_by is None:
        order_by = [F.col("purchase_date").desc_nulls_last()]
    if tie_break is None:
        tie_break = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order_by, *tie_break)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def with_line_amount(df: DataFrame, dtype: str = "decimal(18,2)") -> DataFrame:
    return df.withColumn("line_amount", line_amount("quantity", "price", dtype))


def with_customer_total(
    df: DataFrame,
    col_name: str = "customer_total_revenue",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add the customer's sum of ``line_amount`` to each row; null customers form one group.

    The totals are computed and stored once, with the lines per customer; the join spreads customers with
    more than ``group_rows`` lines over several tasks.
    """
    totals = stable(
        df.groupBy("customer_id").agg(F.sum("line_amount").alias(col_name), F.count(F.lit(1)).alias("_rows"))
    )
    return match(
        df, totals.drop("_rows"), "customer_id", "left", null_safe=True,
        left_counts=totals.select("customer_id", "_rows"), group_rows=group_rows,
    )


def error_reason(critical: Sequence[str] = CRITICAL) -> Column:
    """``"<column>=NULL"`` for each null column, joined by ``", "``; null for a valid row."""
    return F.nullif(
        F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(f"{c}=NULL")) for c in critical]), F.lit("")
    )


def tag_errors(df: DataFrame, critical: Sequence[str] = CRITICAL) -> DataFrame:
    return df.withColumn("error_reason", error_reason(critical))


def split_valid(df: DataFrame, critical: Sequence[str] = CRITICAL) -> tuple[DataFrame, DataFrame]:
    """(rows with all ``critical`` columns, other rows with ``error_reason``)."""
    complete = F.lit(True)
    for c in critical:
        complete = complete & F.col(c).isNotNull()
    return df.where(complete), tag_errors(df.where(~complete), critical)
