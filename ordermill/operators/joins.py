"""Equi-joins of a fact with a table that is unique per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .skew import GROUP_ROWS, crowded_keys, part_counts, same_key

_TYPES = ("inner", "left", "left_semi", "left_anti")


def match(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    *,
    null_safe: bool = False,
    spread_by: Sequence[str] | None = None,
    left_counts: DataFrame | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Join ``left`` with ``right`` on equal ``on`` columns, kept once, taken from ``left``.

    Spark picks the join from the sizes it knows, adaptive execution corrects it at run time and splits
    skewed partitions; building the join starts no job. ``left_semi`` and ``left_anti`` use only the keys
    of ``right``.

    Callers that have counted the keys of ``left`` anyway pass ``left_counts``, the key columns and a row
    count. Rows of ``left`` whose key is crowded are then spread over several tasks by the hash of
    ``spread_by`` (all columns by default), with the matching rows of ``right`` repeated once per task.
    """
    if how not in _TYPES:
        raise ValueError(f"how must be one of {_TYPES}")
    on = [on] if isinstance(on, str) else list(on)
    if how in ("left_semi", "left_anti"):
        right = right.select(*on)
    right_keys = [f"_right_{key}" for key in on]
    right = right.select(
        *[F.col(key).alias(name) for key, name in zip(on, right_keys)],
        *[c for c in right.columns if c not in on],
    )

    equal = same_key(on, right_keys)
    if not null_safe:
        equal = F.lit(True)
        for key, name in zip(on, right_keys):
            equal = equal & (F.col(key) == F.col(name))
    crowded = None if left_counts is None else crowded_keys(left_counts, on, group_rows)
    if crowded is not None:
        spread = F.xxhash64(*(spread_by or left.columns))
        left = part_counts(left, on, crowded).withColumn("_part", F.pmod(spread, F.col("_parts")).cast("int"))
        right = part_counts(right, right_keys, crowded).withColumn(
            "_right_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
        ).drop("_parts")
        equal = equal & (F.col("_part") == F.col("_right_part"))
    return left.join(right, equal, how).drop(*right_keys, "_parts", "_part", "_right_part")


#: Keys of a build side up to which ``filtered_match`` leaves the join to a broadcast, about 100 bytes each.
BROADCAST_KEYS = 500_000
#: Bits of the key filter, and the hashes of a key in it. Blocks of 32,768 bits, 4 KB each: 64 MB for all.
FILTER_BITS, FILTER_HASHES = 1 << 29, 2


def key_filter(keys: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``block`` and ``bitmap``: the Bloom filter of the rows of ``keys``, one row per block of 32,768 bits that has any.

    Of n keys it lets other keys pass with a probability of about (2n / bits)**2. Blocks are built by combining bitmaps before the shuffle.
    """
    places = F.explode(F.array(*_places(keys.columns, bits)))
    return keys.select(places.alias("place")).groupBy((F.bitmap_bucket_number("place") - 1).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))


def _places(columns: Sequence[str], bits: int) -> list[Column]:
    """The bits of a key, counted from 1 as the bitmap functions do. Null keys have places, but match nothing in a join."""
    return [F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(bits)) + 1 for seed in range(FILTER_HASHES)]


def maybe_in(df: DataFrame, on: Sequence[str], bitmaps: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``df`` whose key may be among those of a ``key_filter``; none that is there is lost.

    The filter has a fixed largest size, so broadcasting it is safe; rows are tested where they are, before any shuffle.
    """
    for place in _places(on, bits):
        block, at = F.floor((place - 1) / 32768), F.pmod(place - 1, F.lit(32768)).cast("int")
        named = bitmaps.select(F.col("block").alias("_block"), F.col("bitmap").alias("_bitmap"))
        byte = F.conv(F.hex(F.substring("_bitmap", F.floor(F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = F.shiftrightunsigned(byte, 0).bitwiseAND(F.pow(F.lit(2), F.col("_at") % 8).cast("int")) != 0
        df = df.withColumns({"_own": block, "_at": at}).join(F.broadcast(named), F.col("_own") == F.col("_block")).where(hit)
        df = df.drop("_own", "_at", "_block", "_bitmap")
    return df


def filtered_match(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner", broadcast_keys: int = BROADCAST_KEYS, bits: int = FILTER_BITS
) -> DataFrame:
    """``match`` of a large ``left`` with a ``right`` that has few of its keys: inner or left_semi.

    The rows of ``right`` are counted. Up to ``broadcast_keys`` they are broadcast. Beyond, both sides are shuffled, but rows of
    ``left`` without a partner are dropped before, by a broadcast Bloom filter of the keys of ``right``, whose size is fixed.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError("only rows with a partner can be asked for")
    on = [on] if isinstance(on, str) else list(on)
    if right.limit(broadcast_keys + 1).count() <= broadcast_keys:
        return match(left, F.broadcast(right), on, how)
    return match(maybe_in(left, on, key_filter(right.select(*on), bits), bits), right, on, how)


def on_chosen(facts: DataFrame, chosen: DataFrame, by: str, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """The rows of ``facts`` whose ``by`` is among the rows of ``chosen``, such as dates of a filtered calendar.

    Where ``facts`` is partitioned by ``by``, Spark prunes the scan by the broadcast list: partitions that were not chosen are
    not read. The list is counted first; a longer one than ``broadcast_keys`` is joined without a hint.
    """
    few = chosen.limit(broadcast_keys + 1).count() <= broadcast_keys
    return match(facts, F.broadcast(chosen) if few else chosen, by)
