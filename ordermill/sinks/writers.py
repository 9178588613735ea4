"""Partitioned and plain Parquet sinks; reruns replace what they wrote before.

Rows are gathered by partition value before a partitioned write, so that a partition gets few
files. The ``rebalance`` hint lets adaptive execution split a partition value that holds much of
the data over several tasks and join small ones, instead of sending each value to one task. Where
creating many small files is most of the work, the caller passes how many tasks are to share it.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.history import upsert
from ..operators.joins import match
from ..workspace import remove, staged, staging

def _by_value(df: DataFrame, by: str, tasks: int) -> DataFrame:
    """Each value of ``by`` in one of ``tasks`` tasks. The hash keeps Spark from falling back on an earlier
    partitioning by the same column, which adaptive execution may have joined into one task."""
    return df.repartition(tasks, F.xxhash64(by))


def write_partitions(
    df: DataFrame,
    path: str,
    by: str,
    mode: str = "overwrite",
    incremental: bool = True,
    sort_by: Sequence[str] = (),
    tasks: int | None = None,
    gather: bool = True,
) -> None:
    """Write ``df`` partitioned by ``by``.

    With ``incremental`` an overwrite replaces only the partitions that ``df`` has rows for; the
    setting belongs to this write, not to the session. ``sort_by`` orders the rows inside the
    files, which makes their statistics selective. Adaptive execution spreads the rows over tasks, unless
    ``tasks`` gives their number; then a partition is one file. Without ``gather`` every task writes the rows it has, which saves
    the shuffle where a task has few partition values, as of a table that is partitioned by ``by`` already.
    """
    if gather and tasks is None and df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        raise RuntimeError("spark.sql.adaptive.enabled is off: pass tasks, as nothing else gathers the rows")
    if tasks is not None:
        gathered = _by_value(df, by, tasks)
    else:
        gathered = df.hint("rebalance", by) if gather else df
    gathered = gathered.sortWithinPartitions(by, *sort_by)
    (
        gathered.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if incremental else "static")
        .partitionBy(by)
        .parquet(path)
    )


def write_one_file_each(df: DataFrame, path: str, by: str, incremental: bool = True) -> None:
    """One file per partition value. Meant for aggregates: a value goes to a single task."""
    (
        _by_value(df, by, df.sparkSession.sparkContext.defaultParallelism).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if incremental else "static")
        .partitionBy(by)
        .parquet(path)
    )


def write_snapshot(df: DataFrame, path: str, snapshot_date: datetime.date | str, append: bool = False) -> None:
    """Add ``df`` as the partition ``snapshot_date``; a rerun replaces it unless ``append``."""
    dated = df.withColumn("snapshot_date", F.lit(str(snapshot_date)))
    (
        dated.write.mode("append" if append else "overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(path)
    )


def write_current(df: DataFrame, path: str) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_quarantine(bad: DataFrame, path: str) -> int:
    """Replace what ``path`` holds by the rejected rows, also by none; returns their number.

    They are few and come from every task, so they are gathered into files of a sensible size."""
    write_current(bad.hint("rebalance"), path)
    return bad.sparkSession.read.schema(bad.schema).parquet(path).count()


def save_table(df: DataFrame, name: str, by: str | None = None, path: str | None = None) -> None:
    """Create or replace a catalogue table, partitioned by ``by``; with ``path`` its files lie there, and stay if it is dropped."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    (writer if by is None else writer.partitionBy(by)).saveAsTable(name)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    by: str,
) -> None:
    """Apply ``upsert`` to a partitioned table, rewriting only the partitions it touches: those of
    the updates and those that hold an older row of an updated key.

    The updates and the merged rows are staged first, so no folder is overwritten while it is read. Partitions
    whose last row moved away are removed after the merged rows are in place: a run that failed in between leaves a moved
    row in both, and running the same updates again removes it from the old one.
    """
    target = spark.read.parquet(path)
    if not isinstance(target.schema[by].dataType, (T.DateType, T.IntegralType)):
        raise ValueError("partitions must be dates or whole numbers")
    with staging(spark) as folder:
        updates = staged(updates, f"{folder}/updates")
        outdated = match(target.select(*dict.fromkeys([*keys, by])), updates, keys, "left_semi", null_safe=True)
        touched = staged(outdated.select(by).union(updates.select(by)).distinct(), f"{folder}/touched")
        affected = match(target, touched, by, "left_semi", null_safe=True)
        merged = staged(upsert(affected, updates, keys, order_by), f"{folder}/merged")
        emptied = match(touched, merged.select(by).distinct(), by, "left_anti", null_safe=True)
        values = [row[0] for row in emptied.collect()]  # partition values, never more than the table has folders
        write_partitions(merged, path, by)
    for value in values:
        remove(spark, f"{path.rstrip('/')}/{by}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
