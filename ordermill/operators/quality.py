"""Data-quality checks; each returns a small DataFrame."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schemas import ORDER_KEY
from ..workspace import kept, stable


def duplicates(df: DataFrame, keys: Sequence[str] = ORDER_KEY) -> DataFrame:
    """Keys with more than one row, most rows first."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.where("row_count > 1").orderBy(F.desc("row_count"), *keys)


def grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many key groups have one row, and how many have more."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count_if(F.col("n") == 1).alias("unique_groups"), F.count_if(F.col("n") > 1).alias("dup_groups")
    )


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count, null ratio, minimum and maximum (as text) per column, in one pass over ``df``."""
    columns = list(columns or df.columns)
    figures: list[Column] = [F.count(F.lit(1)).alias("row_cnt")]
    for i, name in enumerate(columns):
        figures += [F.count(name).alias(f"filled_{i}")]
        if not isinstance(df.schema[name].dataType, (T.MapType, T.VariantType)):
            figures += [F.min(name).alias(f"min_{i}"), F.max(name).alias(f"max_{i}")]
    wide = df.agg(*figures)
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("row_cnt"),
            F.try_divide((F.col("row_cnt") - F.col(f"filled_{i}")).cast("double"), F.col("row_cnt").cast("double"))
            .alias("null_ratio"),
            *[
                (F.col(f"{end}_{i}").cast("string") if f"{end}_{i}" in wide.columns else F.lit(None).cast("string"))
                .alias(f"{end}_val")
                for end in ("min", "max")
            ],
        )
        for i, name in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*entries)))


def null_safe_totals(df: DataFrame, amount: str, nullable: str) -> DataFrame:
    """One row: total of ``amount`` (0 when there is none), rows, non-null values of ``nullable``."""
    total = F.sum(amount)
    return df.agg(
        F.coalesce(total, F.lit(0).cast("bigint")).alias("total_amount"),
        F.count(F.lit(1)).alias("row_cnt"),
        F.count(nullable).alias("non_null_cnt"),
    )


def freshness(df: DataFrame, day: str, as_of: datetime.date | str) -> DataFrame:
    """Days from the latest ``day`` to ``as_of``."""
    return df.agg(F.date_diff(F.lit(str(as_of)).cast("date"), F.max(day)).alias("days_since_last_event"))


def null_or_blank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of each column that are null or made of spaces, in one pass."""
    counts = [
        F.count_if(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")).alias(f"bad_{i}")
        for i, c in enumerate(columns)
    ]
    wide = df.agg(F.count(F.lit(1)).alias("total_rows"), *counts)
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"bad_{i}").alias("bad_rows"), F.col("total_rows"))
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*entries)))


def rule_breaks(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """How many rows meet each named condition, in one pass."""
    wide = df.agg(*[F.count_if(rule).alias(f"n_{i}") for i, rule in enumerate(rules.values())])
    entries = [
        F.struct(F.lit(name).alias("rule"), F.col(f"n_{i}").alias("rows")) for i, name in enumerate(rules)
    ]
    return wide.select(F.inline(F.array(*entries)))


def non_positive(df: DataFrame) -> DataFrame:
    """Rows whose quantity or price is zero or less."""
    return rule_breaks(df, {"quantity<=0": F.col("quantity") <= 0, "price<=0": F.col("price") <= 0})


def explode_check(raw: DataFrame, lines: DataFrame) -> DataFrame:
    """One row: products in the nested orders, and lines after exploding them."""
    size = F.when(F.col("products").isNotNull(), F.size("products").cast("bigint"))
    expected = raw.agg(F.coalesce(F.sum(size), F.lit(0)).alias("expected_lines"))
    actual = lines.agg(F.count(F.lit(1)).alias("actual_lines"))
    return expected.unionByName(actual, allowMissingColumns=True).agg(
        F.max("expected_lines").alias("expected_lines"), F.max("actual_lines").alias("actual_lines")
    )


def table_shape(spark: SparkSession, table: str) -> tuple[DataFrame, DataFrame]:
    """(row count, extended description) of a catalogue table; the description's order is its ``position``, as rows of a frame have none."""
    description = spark.sql(f"DESCRIBE EXTENDED {table}").withColumn("position", F.monotonically_increasing_id())
    return spark.table(table).agg(F.count(F.lit(1)).alias("row_count")), description


def join_counts(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """One row: rows of ``left``, rows after joining ``right``, rows of ``left`` without a match.

    ``right`` is reduced to its rows per key, so the joined rows are counted, not made.
    """
    on = [on] if isinstance(on, str) else list(on)
    left_counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_left"))
    right_counts = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_right"))
    per_key = left_counts.join(right_counts, on, "left")
    return per_key.agg(
        F.coalesce(F.sum("_left"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.col("_left") * F.col("_right")), F.lit(0)).alias("rows_after"),
        F.coalesce(F.sum(F.when(F.col("_right").isNull(), F.col("_left"))), F.lit(0)).alias("unmatched_rows"),
    )


def total_mismatches(df: DataFrame, col_name: str = "customer_total_revenue") -> DataFrame:
    """Customers whose total on the rows differs from the sum of their lines."""
    per_total = df.groupBy("customer_id", col_name).agg(F.sum("line_amount").alias("line_amount"))
    return _mismatches(per_total, col_name)


def _mismatches(per_total: DataFrame, col_name: str) -> DataFrame:
    on_rows = per_total.select("customer_id", col_name)
    grouped = per_total.groupBy(F.col("customer_id").alias("_customer")).agg(F.sum("line_amount").alias("grp_total"))
    joined = on_rows.join(grouped, F.col("customer_id").eqNullSafe(F.col("_customer"))).drop("_customer")
    return joined.where(~F.col(col_name).eqNullSafe(F.col("grp_total")))


def reconcile(before: DataFrame, after: DataFrame, col_name: str = "customer_total_revenue") -> DataFrame:
    """Checks around duplicate removal and customer totals, one row (check, value) each.

    ``before`` holds the cleansed lines, ``after`` the unique ones with amounts and totals. The
    columns in question of ``after`` are stored once, and so are their sums per customer and total.
    """
    money = "decimal(38,2)"
    after = kept(after.select(*ORDER_KEY, "customer_id", "line_amount", col_name), "lines")
    per_total = stable(
        after.groupBy("customer_id", col_name).agg(
            F.sum("line_amount").alias("line_amount"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("line_amount").isNull()).alias("null_amounts"),
        )
    )
    grouped = per_total.groupBy("customer_id").agg(F.sum("line_amount").alias("grp_total"))
    checks = [
        before.agg(F.count(F.lit(1)).cast(money).alias("rows_before_dedup")),
        per_total.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).cast(money).alias("rows_after_dedup"),
            F.coalesce(F.sum("null_amounts"), F.lit(0)).cast(money).alias("null_line_amount_rows"),
            F.coalesce(F.sum(F.when(F.col(col_name).isNull(), F.col("rows"))), F.lit(0)).cast(money)
            .alias("null_customer_total_rows"),
            F.sum("line_amount").cast(money).alias("sum_of_lines"),
        ),
        grouped.agg(F.sum("grp_total").cast(money).alias("sum_of_customer_totals")),
        duplicates(after).agg(F.count(F.lit(1)).cast(money).alias("remaining_duplicate_keys")),
        _mismatches(per_total, col_name).agg(F.count(F.lit(1)).cast(money).alias("customer_total_mismatches")),
    ]
    tall = [
        check.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("check"), F.col(name).alias("value")) for name in check.columns
        ])))
        for check in checks
    ]
    return reduce(DataFrame.unionByName, tall)
