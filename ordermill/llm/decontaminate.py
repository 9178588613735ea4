"""Benchmark decontamination by spaced-seed hashing, tolerant of substituted words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import column

#: Words of a window and the words that may differ in it.
WINDOW, SUBSTITUTIONS = 13, 2
#: Word positions that a seed looks at; the others are ignored. Every window with two substitutions holds, for at least one
#: of these masks, a place where the mask sees equal words only (a test goes through all 78 cases).
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
SPAN = 8
#: Seeds of the benchmark that are broadcast at once, about 40 bytes each. A larger benchmark is taken in blocks of items.
BLOCK_SEEDS = 400_000
#: A word is a run of letters and digits; case and everything else are ignored.
WORD = r"[\p{L}\p{N}]+"


def _hashed(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def _seeded(rows: DataFrame, words: str, at: str) -> DataFrame:
    """Each row once per start of a span in its array ``words``, as ``at``, and per mask: ``mask`` and ``seed``."""
    starts = F.when(F.size(words) >= SPAN, F.sequence(F.lit(0), F.size(words) - SPAN))
    rows = rows.withColumn(at, F.explode(starts))
    seeds = [F.struct(F.lit(k).alias("mask"), F.xxhash64(F.lit(k), *(F.get(words, F.col(at) + o) for o in mask)).alias("seed")) for k, mask in enumerate(MASKS)]
    return rows.select("*", F.inline(F.array(*seeds)))


def _aligned() -> Column:
    """What a hit's diagonal holds: windows (first words of all good ones), low (the item's first word aligned) and equal (1 or 0 per word)."""
    shift = F.col("i") - F.col("q")
    low, high = F.greatest(F.lit(0), -shift), F.least(F.size("item"), F.size("words") - shift) - 1
    equal = F.transform(F.sequence(low, high), lambda j: (F.get("words", j + shift) == F.get("item", j)).cast("int"))
    width = F.least(F.lit(WINDOW), F.size("item"))
    allowed = F.when(F.size("item") >= WINDOW, SUBSTITUTIONS).otherwise(0)
    good = lambda e, s: F.aggregate(F.slice(e, s + 1, width), F.lit(0), lambda a, x: a + x) >= width - allowed
    starts = F.when(high - low + 1 >= width, F.sequence(F.lit(0), high - low + 1 - width)).otherwise(F.array().cast("array<int>"))
    return F.transform(F.array(equal), lambda e: F.struct(F.filter(starts, lambda s: good(e, s)).alias("windows"), low.alias("low"), e.alias("equal"), width.alias("width")))[0]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document text and benchmark item that overlap: doc_id, text_key, item_id, doc_start, n_words, n_equal, item_words.

    They overlap if 13 words of the item stand in the document, in a row and with at most two of them replaced; of items of
    8 to 12 words all must stand there; shorter items are not looked for, as they prove nothing. ``doc_start`` and
    ``n_words`` are the stretch from the first such window to the last in the best alignment (most equal words, then the first),
    ``n_equal`` its equal words. Words are runs of letters and digits, lower-cased, compared by 64-bit hash.

    Null and empty texts hold nothing. Null ids are kept as they are; ``text_key`` (xxhash64 of the text) tells rows with one
    id apart; equal rows, and equal items with one id, give one row. Empty tables give an empty result; other columns are
    ignored, whatever their names.

    Documents are never shuffled: each task probes the broadcast seeds of the benchmark, of a bounded number, and looks at the
    overlap where a seed hits. A run of hits is looked at once. A benchmark with more seeds is taken block by block.
    """
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    docs = docs.select(column(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), _hashed(text).alias("words"))
    items = benchmark.select(column(item_col).alias("item_id"), _hashed(column(item_text_col).cast("string")).alias("item")).where(F.size("item") >= SPAN).distinct()
    seeds = items.agg(F.sum((F.size("item") - SPAN + 1) * len(MASKS))).first()[0] or 0
    blocks = -(-seeds // BLOCK_SEEDS) or 1
    items = items.withColumn("item_key", F.xxhash64("item_id", "item"))
    found = []
    for block in range(blocks):
        own = items.where(F.pmod("item_key", F.lit(blocks)) == block)
        known = _seeded(own, "item", "q").select("seed", F.col("mask").alias("item_mask"), "q", "item_key")
        hits = (_seeded(docs, "words", "i").join(F.broadcast(known), "seed").where(F.col("mask") == F.col("item_mask"))
                .join(F.broadcast(own), "item_key"))
        # where the same mask also fits one word before, that hit tells the same
        before = [F.array(*((F.get("words", F.col("i") - 1 + o) == F.get("item", F.col("q") - 1 + o)) for o in mask)) for mask in MASKS]
        follows = F.forall(F.element_at(F.array(*before), F.col("mask") + 1), lambda x: x)
        hits = hits.where(~((F.col("i") > 0) & (F.col("q") > 0) & F.coalesce(follows, F.lit(False))))
        found.append(hits.select("doc_id", "text_key", "item_id", "item_key", F.size("item").alias("item_words"), (F.col("i") - F.col("q")).alias("shift"), _aligned().alias("a")))
    found = reduce(DataFrame.unionAll, found).where(F.size("a.windows") > 0)
    first, last = F.col("a.windows")[0], F.element_at("a.windows", -1) + F.col("a.width")
    equal = F.aggregate(F.slice("a.equal", first + 1, last - first), F.lit(0), lambda a, x: a + x)
    found = found.select("doc_id", "text_key", "item_id", "item_key", "item_words", F.struct(
        equal.alias("n_equal"), (-(first + F.col("a.low") + F.col("shift"))).alias("back"), (last - first).alias("n_words")).alias("best"))
    return found.groupBy("doc_id", "text_key", "item_id", "item_words").agg(F.max("best").alias("best")).select(
        "doc_id", "text_key", "item_id", (-F.col("best.back")).alias("doc_start"), "best.n_words", "best.n_equal", "item_words")


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns: str) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose texts overlap with no benchmark item (see ``find_leaks``)."""
    leaks = find_leaks(docs, benchmark, id_col, text_col, **columns).select("doc_id", "text_key").distinct()
    # the row travels as a struct, so that its columns may have any names
    rows = docs.select(F.struct(*(column(c) for c in docs.columns)).alias("whole"), column(id_col).alias("id"),
                       F.xxhash64(F.coalesce(column(text_col).cast("string"), F.lit(""))).alias("key"))
    return rows.join(leaks, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key")), "left_anti").select("whole.*")
