"""Type-2 history kept in files, to which each load only adds what changed.

Open versions lie in partitions by a hash of the key, closed ones in a partition per load. A load reads and rewrites the open
partitions of the keys it changes; the versions it closes go to a partition of their own, and what was closed before stays as it
is. Only keys whose changes are not later than their open version need their whole history; the partitions it lies in
are then written again without it. A load becomes visible as a whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.history import scd2
from ..operators.joins import match
from ..operators.skew import group_sizes
from ..sinks import VersionedTable
from ..workspace import staged, staging

#: Partitions of the open versions. A load that changes few keys rewrites few of them.
BUCKETS = 64
_PART = "part"
_CLOSED = "closed-"


def history_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, _PART)


def read_history(table: VersionedTable) -> DataFrame:
    """All versions, in the columns of ``scd2``."""
    return table.read().drop(_PART)


def _open_part(keys: Sequence[str], buckets: int) -> Column:
    return F.concat(F.lit("open-"), F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string"))


def apply_changes(table: VersionedTable, changes: DataFrame, keys: Sequence[str], tracked: Sequence[str], effective: str, buckets: int = BUCKETS) -> int:
    """Bring the stored history up to ``changes`` (``keys``, ``tracked`` and ``effective``), as ``scd2`` would; returns the version.

    Changes may come in any order and more than once. ``buckets`` must stay the same from load to load.
    """
    keys, tracked = list(keys), list(tracked)
    states = [*keys, *tracked, "valid_from"]
    this_load = f"{_CLOSED}{uuid.uuid4().hex}"
    with staging(table.spark) as folder:
        changes = staged(changes.select(*keys, *tracked, effective), f"{folder}/changes")
        first_load = table.version() is None
        if first_load:
            history, rest, replaced, bound = changes.limit(0).select(*keys, *tracked, F.col(effective).alias("valid_from")), [], None, None
        else:
            parts = [row[0] for row in changes.select(_open_part(keys, buckets)).distinct().collect()]  # at most ``buckets``
            opened = table.read(values=parts)
            earliest = staged(changes.groupBy(*keys).agg(F.min(effective).alias("_first"), F.count(F.lit(1)).alias("_n")), f"{folder}/earliest")
            bound = 1 + (earliest.agg(F.max("_n")).first()[0] or 0)  # a key has one open version
            mine = match(opened, earliest.drop("_n"), keys, null_safe=True)
            # A change on the day of an open version may undo it, so the version before it is needed as well.
            late = staged(mine.where(F.col("_first") <= F.col("valid_from")).select(*keys), f"{folder}/late")
            rest, replaced, history = [match(opened, earliest, keys, "left_anti", null_safe=True)], parts, mine.select(*states)
            if not late.isEmpty():
                closed = table.read(values=[value for value in table.manifest().live if value.startswith(_CLOSED)])
                earlier = staged(match(closed, late, keys, "left_semi", null_safe=True), f"{folder}/earlier")
                bound += group_sizes(earlier, keys).largest
                torn = [row[0] for row in earlier.select(_PART).distinct().collect()]  # one per load that closed a version of these keys
                rest.append(match(table.read(values=torn), late, keys, "left_anti", null_safe=True))
                replaced, history = [*parts, *torn], history.unionByName(earlier.select(*states))
        versions = scd2(history, changes, keys, tracked, effective, group_bound=bound)
        part = F.when(F.col("is_current"), _open_part(keys, buckets)).otherwise(this_load)
        rows = versions.withColumn(_PART, part)
        for others in rest:
            rows = rows.unionByName(others)
        return table.replace(rows, replaced, sort_by=keys)
