"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import column, written

#: A source's documents are ordered by a hash and cut into slices of about so many rows, each summed by itself.
SLICE_ROWS = 1_000
WORD = r"[^\x20\x09-\x0D]+"
_BEFORE = (Window.unboundedPreceding, -1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def weighed(sources: DataFrame, weights: Sequence[int] | Mapping[str | None, int]) -> DataFrame:
    """Adds ``place`` (by code point, null last) and ``weight``: the given weights repeating, or those of a mapping (others: 0)."""
    sources = sources.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    if isinstance(weights, Mapping):
        chosen = F.lit(0)
        for name, weight in weights.items():
            chosen = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(weight)).otherwise(chosen)
    else:
        chosen = F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    return sources.withColumn("weight", chosen.cast("double"))


def water_filled(sources: DataFrame, share: float, epochs: int) -> DataFrame:
    """Adds ``target``: ``share`` of all sizes, dealt out by weight, none above ``epochs`` times its source's size.

    Clamping every source above its cap and sharing the excess anew by weight, until none is above, ends at one level L
    with target = min(cap, weight * L). Sources are clamped in the order of cap / weight, so the rounds are prefix sums
    in that order: L is what the first unclamped source and all after it share. One row per source, so the one task of
    these windows holds as many rows as there are sources.
    """
    order = Window.orderBy(F.try_divide("cap", "weight").asc_nulls_last(), "place")
    everything = Window.partitionBy(F.lit(0))
    sources = (
        sources.withColumn("cap", (F.col("source_size") * epochs).cast("double"))
        .withColumn("left", F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(order.rowsBetween(*_BEFORE)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order.rowsBetween(*_BEFORE)), F.lit(0.0)))
        .withColumn("turn", F.row_number().over(order))
        .withColumn("level", F.min(F.when((F.col("weight") > 0) & (F.col("weight") * F.col("left") <= F.col("cap") * F.col("open")), F.struct("turn", "left", "open"))).over(everything))
    )
    poured = F.try_divide(F.col("weight") * F.col("level.left"), F.col("level.open"))
    target = F.when(F.col("weight") <= 0, 0.0).when(F.col("level").isNull() | (F.col("turn") < F.col("level.turn")), F.col("cap")).otherwise(poured)
    return sources.withColumn("target", F.coalesce(F.least(target, F.col("cap")), F.lit(0.0))).drop("left", "open", "turn", "level", "cap")


def tie(docs: DataFrame, seed: int, id_col: str, text_col: str) -> Column:
    """The seeded hash of a row's id and text that orders the documents of a source."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(column(id_col).cast("string"), F.lit("null")), F.coalesce(column(text_col).cast("string"), F.lit(""))))


def mix(docs: DataFrame, weights: Sequence[int] | Mapping[str | None, int], share: float = 1.5, epochs: int = 2, seed: int = 0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """How often the mix takes each row of ``docs``: doc_id, source, tie, size, source_size, target, repeats, taken.

    A source's target is ``target`` words. Its documents are all taken target // source_size times, and the fraction that
    is left is filled with documents in the order of a seeded hash, each once more, as long as at least half of the next
    one still fits: a source's taken words miss its target by half a document at most. Reruns take the same documents.

    Size is the number of words (null and empty texts: 0, taken as 0 words). A null source is a source of its own and the
    last; null and repeated ids give a row each; equal rows are interchangeable. An empty table gives an empty result.
    ``tie`` is the hash that orders the documents. Other columns are ignored, whatever their names.

    Texts are read once: what follows works on the stored sizes. A crowded source is summed in slices of its hash order.
    """
    sized = written(docs.select(column(id_col).alias("doc_id"), column(source_col).cast("string").alias("source"),
                                word_count(column(text_col)).alias("size"), tie(docs, seed, id_col, text_col).alias("tie")), "sizes")
    sources = weighed(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), weights)
    sources = water_filled(sources, share, epochs).select(
        "source", "place", "source_size", "target", F.ceil(F.col("n") / SLICE_ROWS).alias("slices"),
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("whole"))
    at = F.conv(F.substring("tie", 1, 8), 16, 10).cast("long")
    sized = sized.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "d.*", "place", "source_size", "target", "whole", F.floor(at * F.col("slices") / F.lit(float(1 << 32))).alias("slice"))
    earlier = sized.groupBy("place", "slice").agg(F.sum("size").alias("all")).select(
        "place", "slice", F.coalesce(F.sum("all").over(Window.partitionBy("place").orderBy("slice").rowsBetween(*_BEFORE)), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("place", "slice").orderBy("tie", "doc_id", "size").rowsBetween(*_BEFORE)
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(earlier, ["place", "slice"])
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    once_more = (2 * (F.col("earlier") + F.col("inside")) + F.col("size") <= 2 * rest) & (rest > 0)
    return (placed.withColumn("repeats", F.col("whole") + once_more.cast("long"))
            .select("doc_id", "source", "tie", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken")))


def mixed_rows(docs: DataFrame, weights: Sequence[int] | Mapping[str | None, int], share: float = 1.5, epochs: int = 2, seed: int = 0,
               id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, with all their columns, each as often as ``mix`` takes it.

    Rows with the same id and text share what is taken of them evenly, the rest going to any of them.
    """
    taken = mix(docs, weights, share, epochs, seed, id_col, text_col, source_col)
    taken = taken.groupBy("tie").agg(F.sum("repeats").alias("taken"), F.count("*").alias("rows")).where("taken > 0")
    # the row travels as a struct, so that its columns may have any names
    rows = docs.select(F.struct(*(column(c) for c in docs.columns)).alias("whole"), tie(docs, seed, id_col, text_col).alias("tie")).join(taken, "tie")
    turn = F.row_number().over(Window.partitionBy("tie").orderBy("taken"))
    times = F.floor(F.col("taken") / F.col("rows")) + (turn <= F.col("taken") % F.col("rows")).cast("int")
    rows = rows.withColumn("times", times).where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return rows.select("whole.*")
