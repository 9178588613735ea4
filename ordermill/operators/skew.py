"""Group sizes and crowded keys.

One rule holds for windows that must see a whole group at once: measure the largest group first (a
map-side combined count of the key columns alone). Groups of at most ``GROUP_ROWS`` rows use Spark's
own window; anything larger takes a path that spreads the group over tasks and gives the same rows.
Joins are left to Spark, unless the caller has the counts at hand.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..workspace import file_bytes, stable

GROUP_ROWS = 5_000_000
#: Bytes of input files per task of ``dealt``: about 550,000 order lines in Parquet.
TASK_BYTES = 8 << 20


class GroupSizes(NamedTuple):
    rows: int
    largest: int


def group_sizes(df: DataFrame, keys: Sequence[str]) -> GroupSizes:
    """Rows of ``df`` and of its largest group; only these two numbers reach the driver."""
    if not keys:
        rows = df.count()
        return GroupSizes(rows, rows)
    sizes = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0)))
        .first()
    )
    return GroupSizes(*sizes)


def groups_fit(df: DataFrame, keys: Sequence[str], group_rows: int, group_bound: int | None = None) -> bool:
    """Whether no group has more than ``group_rows`` rows; a ``group_bound`` known to the caller
    that is low enough saves the count."""
    if group_bound is not None and group_bound <= group_rows:
        return True
    return group_sizes(df, keys).largest <= group_rows


def crowded_keys(counts: DataFrame, keys: Sequence[str], group_rows: int = GROUP_ROWS) -> DataFrame | None:
    """Of ``counts``, keys and their numbers of rows: those with more than ``group_rows`` rows, and
    ``_parts``, the number of tasks each needs.

    Returns None when there is none. The list has fewer than rows / ``group_rows`` entries, so
    broadcasting it is safe, and it is stored once so that every use sees the same keys.
    """
    counts = counts.toDF(*keys, "n").where(F.col("n") > group_rows)
    crowded = stable(counts.select(*keys, F.ceil(F.col("n") / group_rows).cast("int").alias("_parts")))
    return None if crowded.isEmpty() else crowded


def dealt(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df`` shuffled by ``by``, in as many tasks as the files it is made from have ``TASK_BYTES``, so that a task gets no more
    rows when the input grows. Small input, and frames that come from no files, stay as they are.

    Adaptive execution joins partitions until they have 64 MB as shuffled, which can be ten million short rows; sorts and hash tables
    that meet in one task then take gigabytes. It leaves a given number of tasks alone.
    """
    tasks = -(-file_bytes(df) // TASK_BYTES)
    return df.repartition(tasks, *by) if tasks > 1 else df


def same_key(left: Sequence[str], right: Sequence[str]) -> Column:
    """Null-safe equality of two key lists."""
    condition = F.lit(True)
    for a, b in zip(left, right):
        condition = condition & F.col(a).eqNullSafe(F.col(b))
    return condition


def part_counts(df: DataFrame, keys: Sequence[str], crowded: DataFrame) -> DataFrame:
    """``df`` with ``_parts`` of its key: 1 unless the key is crowded."""
    names = [f"_crowded_{key}" for key in keys]
    lookup = crowded.toDF(*names, "_found")
    return (
        df.join(F.broadcast(lookup), same_key(keys, names), "left")
        .withColumn("_parts", F.coalesce("_found", F.lit(1)))
        .drop(*names, "_found")
    )
