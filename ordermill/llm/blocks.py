"""Comparing all members of large buckets in bounded tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_blocks(held: DataFrame, members: int, size: int) -> DataFrame:
    """``held`` (bucket, label, row, packed and more), each row once per task that compares it, with ``block``, ``low`` and ``high``.

    Rows of one bucket, low and high are compared in one task: of two blocks, or of one where low = high. Members of the
    bucket's largest label have that label already, so only the others (minor) meet all. Both kinds are cut into blocks of
    about ``members`` rows and ``size`` packed bytes; a row is sent once per minor block, a minor one also once per other block.
    """
    by_label = held.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.sum(F.octet_length("packed")).alias("bytes"))
    sizes = by_label.groupBy("bucket").agg(F.max(F.struct("n", "label", "bytes")).alias("most"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    cut = lambda n, b: F.greatest(F.ceil(n / members), F.ceil(b / size), F.lit(1)).cast("int")
    sizes = sizes.select("bucket", F.col("most.label").alias("major"), cut(F.col("most.n"), F.col("most.bytes")).alias("majors"),
                         cut(F.col("n") - F.col("most.n"), F.col("bytes") - F.col("most.bytes")).alias("minors"))
    rows, mine, is_major = held.join(sizes, "bucket"), F.xxhash64("row"), F.col("label") == F.col("major")
    rows = rows.withColumn("block", F.when(is_major, F.col("minors") + F.pmod(mine, "majors")).otherwise(F.pmod(mine, "minors")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(is_major, F.col("minors")).otherwise(F.col("minors") + F.col("majors")) - 1)))
    return rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("major", "majors", "minors", "other")
