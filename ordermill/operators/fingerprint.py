"""Whether two tables hold the same rows, however they are ordered and stored.

A fingerprint is the number of rows and two sums of 64-bit row hashes, kept wide enough never to overflow. Sums do not depend on the
order of rows, and unlike exclusive-or they see a row that stands twice. A hash covers which columns are null, so a
value that moves to a neighbouring column changes it. Sums need no shuffle of rows and can be taken while a table is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

_WIDE = "decimal(38,0)"
_PARTS = ("rows", "sum_a", "sum_b")


def _sums(columns: Sequence[str]) -> list[Column]:
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in columns]
    nulls = F.concat(F.lit(""), *[F.when(c.isNull(), "1").otherwise("0") for c in quoted])
    hashes = [F.xxhash64(F.lit(seed), nulls, *quoted).cast(_WIDE) for seed in (1, 2)]
    return [F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(h), F.lit(0)).cast(_WIDE).alias(name) for h, name in zip(hashes, _PARTS[1:])]]


def fingerprint(df: DataFrame, by: str | Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """``by``, rows, sum_a and sum_b of ``df``: one row, or one per group. ``columns`` are those that count (by default all), in
    the given order; maps cannot be hashed. One combined aggregate over one scan."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(*_sums(columns or df.columns))


def watched(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, Observation]:
    """``df``, and its fingerprint once an action has read all of it, such as the write that stores it: ``get`` has rows, sum_a, sum_b.

    A task that Spark repeats may be counted twice: a fingerprint that differs is then to be taken again from the files.
    """
    seen = Observation()
    return df.observe(seen, *_sums(columns or df.columns)), seen


def differing_groups(one: DataFrame, two: DataFrame, by: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """``by``, rows_one, rows_two (null: not there) of the groups whose rows differ in any value or in how often they occur.

    ``columns`` default to those of ``one``; ``two`` must have them, with the same types. Only sums per group are joined.
    """
    by, columns = [by] if isinstance(by, str) else list(by), list(columns or one.columns)
    if dict(one.select(*columns).dtypes) != dict(two.select(*columns).dtypes):
        raise ValueError("the columns' types differ")
    both = [fingerprint(df, by, columns).select(*by, F.struct(*_PARTS).alias(name)) for df, name in ((one, "one"), (two, "two"))]
    tagged = both[0].withColumn("two", F.lit(None).cast(both[1].schema["two"].dataType)).unionByName(
        both[1].withColumn("one", F.lit(None).cast(both[0].schema["one"].dataType)))
    joined = tagged.groupBy(*by).agg(F.max("one").alias("one"), F.max("two").alias("two"))  # null keys meet as well
    return joined.where(~F.col("one").eqNullSafe(F.col("two"))).select(*by, F.col("one.rows").alias("rows_one"), F.col("two.rows").alias("rows_two"))
