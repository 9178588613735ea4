"""Files clustered by several columns at once, so that a filter on any of them skips most row groups.

Each column's value becomes its rank among approximate quantiles, so skewed values spread evenly. The bits of the ranks are
interleaved to one number (a Z-order curve), by which the rows are range partitioned and sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Bits of a column's rank: 2**BITS quantiles each.
BITS = 6
#: Accuracy of the quantiles: their ranks err by 1 / ACCURACY of all rows.
ACCURACY = 2000


def ordinal(df: DataFrame, name: str) -> Column:
    """The column as a number that grows with its value; text by its first six bytes."""
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    raise ValueError(f"{name} cannot be put in order")


def z_value(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The interleaved bits of the columns' quantile ranks, the first column's highest. Nulls come first.

    Taking the quantiles is one pass over ``df``; ``2**bits - 1`` of them per column reach the driver.
    """
    if bits * len(columns) > 62:
        raise ValueError("too many bits: at most 62 in all columns together")
    cuts = [k / 2**bits for k in range(1, 2**bits)]
    edges = df.agg(*[F.percentile_approx(ordinal(df, c), cuts, ACCURACY).alias(f"q{k}") for k, c in enumerate(columns)]).first()
    out = F.lit(0).cast("bigint")
    for k, name in enumerate(columns):
        value = ordinal(df, name)
        known = sorted(set(edges[k] or []))
        # the number of edges below the value, found by halving: one comparison per bit
        rank = F.when(value.isNull(), 0).otherwise(_rank(value, known, 0, len(known))).cast("bigint")
        for bit in range(bits):
            place = bit * len(columns) + (len(columns) - 1 - k)
            out = out.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("bigint")), place))
    return out


def _rank(value: Column, edges: list[float], low: int, high: int) -> Column:
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value <= edges[middle], _rank(value, edges, low, middle)).otherwise(_rank(value, edges, middle + 1, high))


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, bits: int = BITS) -> None:
    """Replace ``path`` by ``df``, clustered by ``columns``; ``files`` is the number of range partitions, by default Spark's own."""
    placed = df.withColumn("_z", z_value(df, columns, bits))
    ranged = placed.repartitionByRange(files, "_z") if files else placed.repartitionByRange("_z")
    ranged.sortWithinPartitions("_z", *columns).drop("_z").write.mode("overwrite").parquet(path)
