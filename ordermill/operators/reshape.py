"""Pivot, unpivot and fields of JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


_OTHER = "\u0000other"


def pivot(df: DataFrame, rows: Sequence[str], column: str, values: Sequence[str], amount: str) -> DataFrame:
    """Sum of ``amount`` with one output column per listed value, and ``other`` for all values that are not listed
    and for null. Listing the values fixes the columns and saves a pass."""
    listed = F.when(F.col(column).isin(list(values)), F.col(column)).otherwise(F.lit(_OTHER))
    wide = df.withColumn(column, listed).groupBy(*rows).pivot(column, [*values, _OTHER]).agg(F.sum(amount))
    return wide.withColumnRenamed(_OTHER, "other")


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "metric", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def json_fields(df: DataFrame, column: str, schema: str) -> DataFrame:
    """The fields named in the DDL ``schema`` as columns; text that is no JSON gives nulls."""
    return df.withColumn("_json", F.from_json(column, schema)).select(*df.columns, "_json.*")
