"""Large JSON arrays read by many tasks.

Spark reads a file that is one JSON value in one task. Here the text is cut at every ``}``, which Spark's own text source does
in any byte range of the file, so that each split is a task. What a split's text means depends on what came before it: whether
it begins inside a string, and how deep. Quotes flip the first whatever it was, and brackets are counted for both cases, so one
row per split is enough to work out, by running sums over the splits of a file, how each of them begins. With that known every
split finds its own record ends: a ``}`` outside strings that leads back to the level of the records. Only a record that
crosses the border of two splits is put together in a second, small step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..schemas import CORRUPT

_END = "}"
_COMPRESSED = r"\.(gz|bz2|zst|snappy|lz4|deflate|xz)$"
_SPLIT = ("file", "block")
_BEFORE = (Window.unboundedPreceding, -1)


def _fragments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The text between two ``}``, with its split, its order in it (``at``), and what it does to strings and depth.

    A backslash never stands directly before a fragment, so escapes need no state: ``}`` cannot be escaped.
    """
    rows = spark.read.text(path, lineSep=_END).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"), F.monotonically_increasing_id().alias("at"))
    bare = F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))  # few texts have escapes
    flips = (F.length(bare) - F.length(F.translate(bare, '"', ""))) % 2
    strings = r'"[^"]*("|\z)'
    outside = F.regexp_replace(bare, strings, "")
    after_string = F.regexp_replace(F.concat(F.lit('"'), bare), strings, "")

    def opened(text: Column) -> Column:
        return F.length(F.translate(text, "]", "")) - F.length(F.translate(text, "{[", ""))  # what opens less what closes

    return rows.withColumns({
        "flips": flips,
        "deeper": opened(outside) - F.when(flips == 0, 1).otherwise(0),
        "deeper_in_string": opened(after_string) - F.when(flips == 1, 1).otherwise(0),
    })


def _sum_before(column: Column, window: Window) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(*_BEFORE)), F.lit(0))


def _split_starts(fragments: DataFrame) -> DataFrame:
    """How each split begins (``in_string``: 0 or 1, ``depth``), the level of the file's records, whether the split is the file's
    last and whether the file's last fragment ended with ``}``. One row per split; no text is shuffled for it."""
    inside = Window.partitionBy(*_SPLIT).orderBy("at")
    odd = _sum_before(F.col("flips"), inside) % 2
    changes = [F.when(odd == begins, F.col("deeper")).otherwise(F.col("deeper_in_string")) for begins in (0, 1)]
    splits = (
        fragments.select(*_SPLIT, "at", "file_size", "flips", "deeper", "deeper_in_string", F.octet_length("value").alias("bytes"),
                         F.col("value").rlike(r"^[\s\x{FEFF}]*\[").alias("array"), F.col("value").rlike(r"^\s*\]?\s*\z").alias("hollow"))
        .withColumns({"outside": changes[0], "inside": changes[1]})
        .groupBy(*_SPLIT).agg(
            (F.sum("flips") % 2).alias("flips"), F.sum("outside").alias("outside"), F.sum("inside").alias("inside"), F.max("file_size").alias("file_size"),
            (F.sum("bytes") + F.count(F.lit(1))).alias("bytes"), F.min_by("array", "at").alias("array"),
            F.max_by("hollow", "at").alias("hollow"))
    )
    order, whole = Window.partitionBy("file").orderBy("block"), Window.partitionBy("file")
    splits = splits.withColumn("in_string", _sum_before(F.col("flips"), order) % 2)
    splits = splits.withColumn("change", F.when(F.col("in_string") == 0, F.col("outside")).otherwise(F.col("inside")))
    # Each fragment was counted with one more byte, for its "}"; a byte order mark, which Spark leaves out, has three.
    # Of compressed files the sizes say nothing: there any text after the last "}" but a closing bracket counts as ended.
    missing = F.col("file_size") - F.sum("bytes").over(whole)
    return splits.select(
        *_SPLIT, "in_string", _sum_before(F.col("change"), order).alias("depth"),
        F.first("array").over(order).cast("int").alias("level"),
        (F.lead("block").over(order).isNull()).alias("is_last"),
        F.when(F.col("file").rlike(_COMPRESSED), ~F.col("hollow")).otherwise(missing.isin(0, 3)).alias("closed_file"),
    )


def _pieces(fragments: DataFrame, starts: DataFrame) -> DataFrame:
    """Per split, its text cut after each record end: ``piece`` counts them from 0; ``ended`` unless a later split goes on."""
    inside = Window.partitionBy(*_SPLIT).orderBy("at")
    rows = fragments.drop("file_size").join(starts, list(_SPLIT))
    rows = rows.withColumn("odd", (F.col("in_string") + _sum_before(F.col("flips"), inside)) % 2)
    rows = rows.withColumn("change", F.when(F.col("odd") == 0, F.col("deeper")).otherwise(F.col("deeper_in_string")))
    rows = rows.withColumn("deep", F.col("depth") + F.sum("change").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("open", F.col("is_last") & ~F.col("closed_file") & F.lead("at").over(inside).isNull())  # the file ends without "}"
    ends = ((F.col("odd") + F.col("flips")) % 2 == 0) & (F.col("deep") <= F.col("level")) & ~F.col("open")
    rows = rows.withColumn("ends", ends).withColumn("piece", _sum_before(F.col("ends").cast("int"), inside))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("at", F.concat("value", F.when(F.col("open"), "").otherwise(_END)).alias("text")))), lambda x: x["text"])
    return rows.groupBy(*_SPLIT, "piece", "level").agg(F.array_join(parts, "").alias("text"), F.max("ends").alias("ended"))


def record_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``text`` of every element of the JSON arrays in the files, and of every JSON object of files that are no arrays."""
    fragments = _fragments(spark, path)
    pieces = _pieces(fragments, _split_starts(fragments))
    at_border = (F.col("piece") == 0) | ~F.col("ended")
    first = (F.col("block") == 0) & (F.col("piece") == 0)
    whole = pieces.where(~at_border).select("level", "text", F.lit(False).alias("first"))

    # At most two pieces per split are at its borders. What never ends is left as it is, so nothing grows beyond a split.
    order = Window.partitionBy("file").orderBy("block", "piece")
    border = pieces.where(at_border).withColumns({"first": first, "record": _sum_before(F.col("ended").cast("int"), order)})
    border = border.withColumn("does_end", F.max("ended").over(Window.partitionBy("file", "record")))
    lone = F.when(F.col("does_end"), F.lit(-1)).otherwise(F.col("block"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "piece", "text"))), lambda x: x["text"])
    joined = border.groupBy("file", "record", lone.alias("lone"), "level").agg(F.array_join(parts, "").alias("text"), F.max("first").alias("first"))
    rows = whole.unionByName(joined.select("level", "text", "first"))

    text = F.when(F.col("first") & (F.col("level") == 1), F.regexp_replace("text", r"^[\s\x{FEFF}]*\[", "")).otherwise(F.col("text"))
    rows = rows.select("level", F.regexp_replace(text, r"^[\s,\x{FEFF}]+", "").alias("text"))
    return rows.where((F.col("text") != "") & ~((F.col("level") == 1) & F.col("text").rlike(r"^\]\s*\z"))).select("text")


def read_json_records(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """The records of JSON files that are each one array or object, with the columns of ``schema``, read by many tasks per file.

    Rows are those of Spark's reader with ``multiLine`` for files that are valid JSON in UTF-8. A record that does not parse
    has its text in ``_corrupt_record``, if the schema has that column, and the records around it stay; where its brackets or quotes
    do not match, those after it may be set aside with it, a row per split. Elements that are no objects are set aside with
    the next record. A file of several objects gives all of them. Compressed files cannot be split.

    The text is shuffled once, by split (``spark.sql.files.maxPartitionBytes``).
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return record_texts(spark, path).select(F.from_json("text", schema, options).alias("record")).select("record.*")
