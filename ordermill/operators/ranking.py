"""Ranks and top-N per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..workspace import stable
from .joins import match
from .ordered import prefix_sum, row_numbers
from .skew import GROUP_ROWS, groups_fit

# Up to this top Spark itself cuts each group down in every task, before the shuffle: the default of
# spark.sql.optimizer.windowGroupLimitThreshold. One task then gets at most this many rows of a group from each before it.
NATIVE_TOP = 1000


def _names(order: Sequence[tuple[str, str]]) -> list[str]:
    return [name for name, _ in order]


def _columns(order: Sequence[tuple[str, str]]) -> list[Column]:
    return [
        F.col(name).desc_nulls_last() if direction == "desc" else F.col(name).asc_nulls_first()
        for name, direction in order
    ]


def ranked(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[tuple[str, str]],
    how: str = "row_number",
    top: int | None = None,
    out: str = "rank",
    group_rows: int = GROUP_ROWS,
    group_bound: int | None = None,
) -> DataFrame:
    """Number the rows of each group by ``order`` (pairs of column and ``"asc"`` or ``"desc"``),
    keeping numbers up to ``top``.

    ``how`` is ``row_number``, ``rank`` or ``dense_rank``; the last two give equal rows equal
    numbers and keep them all. ``group=[]`` ranks the whole frame. ``group_bound`` is a known bound
    on the rows of a group. Tops beyond ``NATIVE_TOP`` number all rows, in slices where a group is
    large or is the whole frame, and give the same rows.
    """
    if how not in ("row_number", "rank", "dense_rank"):
        raise ValueError("how must be 'row_number', 'rank' or 'dense_rank'")
    group, columns = list(group), _columns(order)
    if how == "row_number":
        numbered = _row_number(df, group, columns, top, out, group_rows, group_bound)
    elif group and groups_fit(df, group, group_rows, group_bound):
        function = F.rank() if how == "rank" else F.dense_rank()
        numbered = df.withColumn(out, function.over(Window.partitionBy(*group).orderBy(*columns)))
        numbered = numbered if top is None else numbered.where(F.col(out) <= top)
    else:
        numbered = _tied_rank(df, group, order, how, top, out, group_rows)
    return numbered.withColumn(out, F.col(out).cast("int" if top is not None else "bigint"))


def _row_number(df, group, columns, top, out, group_rows, group_bound=None):
    if top is not None and top <= NATIVE_TOP:
        if not group:
            # The limit is taken per task first; the window then sees ``top`` rows.
            df = df.orderBy(*columns).limit(top)
        window = Window.partitionBy(*group).orderBy(*columns)
        return df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= top)
    numbered = row_numbers(df, group, columns, out, group_rows, group_bound)
    return numbered if top is None else numbered.where(F.col(out) <= top)


def _tied_rank(df, group, order, how, top, out, group_rows):
    """Rank the distinct values of each group, counted map-side, and look the ranks up again."""
    names, columns = _names(order), _columns(order)
    values = df.groupBy(*group, *names).agg(F.count(F.lit(1)).alias("_copies"))
    if top is not None:
        # Ranks up to ``top`` lie within the first ``top`` distinct values.
        values = _row_number(values, group, columns, top, "_dense", group_rows)
    if how == "dense_rank":
        ranks = values.withColumnRenamed("_dense", out) if top is not None else row_numbers(
            values, group, columns, out, group_rows
        )
    else:
        ranks = prefix_sum(values, group, columns, F.col("_copies"), "_upto", group_rows, group_bound=top)
        ranks = ranks.withColumn(out, F.col("_upto") - F.col("_copies") + 1)
        ranks = ranks if top is None else ranks.where(F.col(out) <= top)
    ranks = stable(ranks.select(*group, *names, out))
    return match(df, ranks, [*group, *names], null_safe=True, group_rows=group_rows)
