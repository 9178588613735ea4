"""Upserts, slowly changing dimensions and runs of days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .joins import match
from .lines import deduplicate
from .ordered import neighbour
from .skew import GROUP_ROWS, group_sizes


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """``target`` with the rows of ``updates`` replaced or added; the first row per key by
    ``order_by`` wins among the updates. Applying the same updates again changes nothing."""
    latest = deduplicate(updates, keys, order_by=order_by)
    kept = match(target, updates, keys, "left_anti", null_safe=True)
    return kept.unionByName(latest.select(*target.columns))


def scd2(
    dim: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective: str,
    group_rows: int = GROUP_ROWS,
    group_bound: int | None = None,
) -> DataFrame:
    """Type-2 history: ``keys``, ``tracked``, ``valid_from``, ``valid_to``, ``is_current``.

    ``dim`` has ``keys``, ``tracked`` and ``valid_from``; ``changes`` has ``effective`` instead.
    A change on the day of an older version replaces it, and a change to the same values opens no
    version. Changes may arrive late and in any order; each version ends where the next begins.
    When ``dim`` is an earlier result, with ``valid_to`` and ``is_current``, the rows of keys
    without a change pass through as they are. A ``group_bound`` on the rows of a key, known to the
    caller, saves counting them.
    """
    keys, tracked = list(keys), list(tracked)
    columns = [*keys, *tracked, "valid_from"]
    untouched = None
    if {"valid_to", "is_current"} <= set(dim.columns):
        untouched = match(dim, changes, keys, "left_anti", null_safe=True)
        dim = match(dim, changes, keys, "left_semi", null_safe=True)
    versions = dim.select(*columns, F.lit(0).alias("_source")).unionByName(
        changes.select(*keys, *tracked, F.col(effective).alias("valid_from"), F.lit(1).alias("_source"))
    )
    # Neither duplicate removal nor the filter below adds rows, so one count bounds both windows.
    bound = group_sizes(versions, keys).largest if group_bound is None else group_bound
    if bound <= group_rows:
        versions = versions.repartition(*keys)  # the one shuffle that duplicate removal and both windows need
    versions = deduplicate(versions, [*keys, "valid_from"], order_by=[F.desc("_source")]).drop("_source")
    order = [F.col("valid_from").asc()]
    states = versions.withColumn("_state", F.struct(*tracked))
    changed = neighbour(states, keys, order, "_state", "_previous", -1, group_rows, bound).where(
        ~F.col("_state").eqNullSafe(F.col("_previous"))
    )
    dated = neighbour(changed.select(*columns), keys, order, "valid_from", "valid_to", 1, group_rows, bound)
    result = dated.withColumn("is_current", F.col("valid_to").isNull())
    return result if untouched is None else result.unionByName(untouched.select(*result.columns))


def islands(df: DataFrame, key: str, day: str) -> DataFrame:
    """Runs of consecutive days per key: ``start_day``, ``end_day``, ``days``.

    Rows are reduced to one per key and day first, so the ordered window never sees more rows of
    a key than there are calendar days.
    """
    if not isinstance(df.schema[day].dataType, T.DateType):
        raise ValueError(f"{day} must be a date")
    days = df.select(key, day).where(F.col(day).isNotNull()).distinct()
    place = F.row_number().over(Window.partitionBy(key).orderBy(day))
    return (
        days.withColumn("_run", F.date_sub(F.col(day), place))
        .groupBy(key, "_run")
        .agg(F.min(day).alias("start_day"), F.max(day).alias("end_day"), F.count(F.lit(1)).alias("days"))
        .drop("_run")
    )
