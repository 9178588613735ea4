"""Running sums, row numbers and neighbours in ordered groups of any size.

Small groups use one native window. When a group outgrows ``group_rows`` the rows are range
partitioned by (group, order) into slices, each slice is computed on its own, and what must be
carried over is worked out from one summary row per slice. In a range partitioning at most one
group continues from an earlier slice, so there are at most as many carried rows as slices; that
bounds what is broadcast. A ``group_bound`` that the caller knows saves counting the groups. Both ways
give the same types and values. A whole frame as one group (``group=[]``) always takes the slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..workspace import kept
from .skew import GROUP_ROWS, groups_fit, same_key

_SLICE = "_slice"
_SEQ = "_seq"


def _slices(df: DataFrame, group: Sequence[str], order: Sequence[Column], group_rows: int) -> DataFrame:
    """``df`` with its slice number; slices follow (group, order) and hold about a quarter of
    ``group_rows`` rows. The sequence number separates rows that agree in everything else."""
    stored = kept(df, "rows")
    count = max(1, -(-stored.count() * 4 // group_rows))
    numbered = stored.withColumn(_SEQ, F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(count, *[F.col(key) for key in group], *order, F.col(_SEQ))
    return kept(ranged.withColumn(_SLICE, F.spark_partition_id()), "slices")


def _carry(local: DataFrame, carried: DataFrame, group: Sequence[str], values: Sequence[str]) -> DataFrame:
    names = [f"_carry_{key}" for key in [*group, _SLICE]]
    lookup = carried.select(*[F.col(key).alias(name) for key, name in zip([*group, _SLICE], names)], *values)
    return local.join(F.broadcast(lookup), same_key([*group, _SLICE], names), "left").drop(*names)


def prefix_sum(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    value: Column,
    out: str,
    group_rows: int = GROUP_ROWS,
    group_bound: int | None = None,
) -> DataFrame:
    """``out`` = sum of ``value`` over the rows of the group up to and including this one."""
    window = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    native = df.withColumn(out, F.sum(value).over(window))
    if group and groups_fit(df, group, group_rows, group_bound):
        return native
    kind = native.schema[out].dataType
    sliced = _slices(df.withColumn("_value", value.cast(kind)), group, order, group_rows)
    before = Window.partitionBy(*group).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.groupBy(*group, _SLICE).agg(F.sum("_value").alias("_total"))
        .withColumn("_value", F.sum("_total").over(before).cast(kind))
        .where(F.col("_value").isNotNull())
        .select(*group, _SLICE, "_value", F.lit(True).alias("_carried"))
    )
    # What earlier slices add up to is the first row of its slice, so one sum gives every total and no scale is lost.
    rows = sliced.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    inside = Window.partitionBy(*group, _SLICE).orderBy(F.col("_carried").desc(), *order, _SEQ).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.sum("_value").over(inside).cast(kind)).where(~F.col("_carried")).select(*df.columns, out)


def row_numbers(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    out: str,
    group_rows: int = GROUP_ROWS,
    group_bound: int | None = None,
) -> DataFrame:
    """``out`` = 1, 2, 3, ... inside each group."""
    return prefix_sum(df, group, order, F.lit(1).cast("bigint"), out, group_rows, group_bound)


def neighbour(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    column: str,
    out: str,
    step: int = -1,
    group_rows: int = GROUP_ROWS,
    group_bound: int | None = None,
) -> DataFrame:
    """``out`` = ``column`` of the previous (``step=-1``) or next (``step=1``) row of the group."""
    if step not in (-1, 1):
        raise ValueError("step must be -1 or 1")
    shift = F.lag if step == -1 else F.lead
    if group and groups_fit(df, group, group_rows, group_bound):
        return df.withColumn(out, shift(column).over(Window.partitionBy(*group).orderBy(*order)))
    sliced = _slices(df, group, order, group_rows)
    inside = Window.partitionBy(*group, _SLICE).orderBy(*order, _SEQ)
    # A struct tells a neighbour whose value is null from a missing neighbour.
    local = sliced.withColumn("_shifted", shift(F.struct(column)).over(inside))
    opposite = (F.lead if step == -1 else F.lag)(F.struct(column)).over(inside)
    edges = sliced.withColumn("_opposite", opposite).where(F.col("_opposite").isNull())
    carried = edges.withColumn(
        "_edge", shift(F.struct(column)).over(Window.partitionBy(*group).orderBy(_SLICE))
    ).where(F.col("_edge").isNotNull())
    found = F.coalesce("_shifted", "_edge")
    return (
        _carry(local, carried, group, ["_edge"])
        .withColumn(out, found[column])
        .drop("_shifted", "_edge", _SLICE, _SEQ)
    )
