"""Quality rules: base counts per document, and a hashed n-gram log-likelihood ratio against the raw corpus."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import column, written

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: A unit is a run of letters and digits, or a run of other solid characters.
UNIT = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+"
#: N-grams are counted in so many classes of their hashes; the model never has more rows.
BUCKETS = 16_384
#: Added to every count.
SMOOTHING = 1.0
#: Trusted rows the target model is fitted on, those of the smallest id hashes: a bound for what is broadcast.
TRUSTED_ROWS = 20_000
#: A document is kept if its score per n-gram, in nats, is at least this: what the raw corpus explains much better than
#: the trusted rows goes, whatever its length.
THRESHOLD = -0.2


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where lambdas use it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, size: int = 5) -> Column:
    """How many words stand in a window of ``size`` words that the same text has at least twice (windows compared by hash)."""

    def hashes(w):
        return F.when(F.size(w) > size, F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(size)))))

    def positions(h):
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))  # array_sort would call a lambda per comparison
        same = lambda s, x, j: F.get(s, j - 1)["h"].eqNullSafe(x["h"]) | F.get(s, j + 1)["h"].eqNullSafe(x["h"])
        return _let(pairs, lambda s: F.sort_array(F.transform(F.filter(s, lambda x, j: same(s, x, j)), lambda x: x["i"])))

    def covered(p):
        ahead = F.transform(p, lambda v, k: F.least(F.coalesce(F.get(p, k + 1) - v, F.lit(size)), F.lit(size)))
        return F.aggregate(ahead, F.lit(0), lambda a, x: a + x)

    return F.coalesce(_let(hashes(words), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _let(positions(h), covered))), F.lit(0)).cast("long")


def _buckets(units: Column) -> Column:
    """Hash classes of a text's units and pairs of neighbouring units."""
    one = F.transform(units, lambda u: F.pmod(F.xxhash64(u), F.lit(BUCKETS)).cast("int"))
    two = F.transform(units, lambda u, i: F.when(i > 0, F.pmod(F.xxhash64(F.get(units, i - 1), u), F.lit(BUCKETS)).cast("int")))
    return F.concat(one, two)


def _units(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(UNIT), F.lit(0))


def fitted(docs: DataFrame, trusted: DataFrame, trusted_rows: int = TRUSTED_ROWS) -> np.ndarray:
    """The weight of every n-gram class: log-likelihood ratio between the trusted rows' and all rows' multinomials.

    ``docs`` has doc_id and text; ``trusted`` has doc_id. Counts of the raw corpus are over all rows. BUCKETS numbers
    reach the driver, whatever goes in. Without trusted rows every weight is 0.
    """
    chosen = trusted.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted_rows)
    marked = docs.join(F.broadcast(chosen.withColumn("trusted", F.lit(1))), "doc_id", "left").select("text", F.coalesce("trusted", F.lit(0)).alias("trusted"))
    # A column of its own, so that Spark generates code for the explode; a plain explode of it would add a filter on the array's
    # size, for which the classes would be made a second time.
    classes = marked.select("trusted", _let(_units(F.col("text")), _buckets).alias("classes"))
    counts = (classes.select("trusted", F.explode_outer("classes").alias("bucket")).where("bucket is not null")
              .groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("target")).collect())
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bucket, all_rows, trusted_rows in counts:
        raw[bucket], target[bucket] = all_rows, trusted_rows
    if not target.any():
        return np.zeros(BUCKETS)
    of = lambda n: np.log((n + SMOOTHING) / (n.sum() + SMOOTHING * BUCKETS))
    return of(target) - of(raw)


def judged(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, score and verdict for every row of ``docs``, next to its own columns' id.

    ``trusted`` holds the ids (column ``id_col``) of documents known to be good. Result: doc_id, n_words, word_chars (code
    points in words), n_symbols, n_dup_lines (lines with a word, equal to an earlier one), n_repeat_words (words in 5-word
    windows that the text has twice or more), base_failed (under 10 words, or over 20 % repeated), score (mean weight of
    the text's n-grams; none: 0), kept (not base_failed and score >= ``threshold``).

    Null and empty texts have no words and fail. Null and repeated ids are judged row by row; null ids are never trusted.
    An empty table gives an empty result; other columns are ignored, whatever their names. Nothing is shuffled but n-gram
    class counts, so neither crowded sources nor copies matter.
    """
    return _counted(docs, trusted, threshold, id_col, text_col, [column(id_col).alias("doc_id")])


def clean_only(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with all their columns."""
    row = F.struct(*(column(c) for c in docs.columns)).alias("row")
    return _counted(docs, trusted, threshold, id_col, text_col, [row]).where("kept").select(
        *(F.col("row").getField(c).alias(c) for c in docs.columns))


def _counted(docs, trusted, threshold, id_col, text_col, carried):
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    known = docs.select(column(id_col).alias("doc_id"), text.alias("text"))
    weights = F.lit(fitted(known, trusted.select(column(id_col).alias("doc_id"))))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))
    total = lambda b: F.aggregate(b, F.lit(0.0), lambda a, x: a + F.coalesce(F.get(weights, x), F.lit(0.0)))
    score = _let(_let(_units(F.col("text")), _buckets), lambda b: F.when(F.size(b) > 1, total(b) / (F.size(b) - 1)).otherwise(0.0))
    return (
        docs.select(*carried, text.alias("text"))
        .withColumn("measured", _let(words, lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).alias("n_repeat_words"))))
        .withColumn("n_words", F.col("measured.n_words"))
        .withColumn("word_chars", F.col("measured.word_chars"))
        .withColumn("n_symbols", F.regexp_count("text", F.lit(SYMBOL)).cast("long"))
        .withColumn("n_dup_lines", _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"))
        .withColumn("n_repeat_words", F.col("measured.n_repeat_words"))
        .withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
        .withColumn("score", score)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
        .drop("text", "measured")
    )
