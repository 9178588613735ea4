"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .frames import written


def labelled(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node reachable, for every node of ``edges`` (a, b: longs). Nodes without edges have no row.

    Each round gives a node the smallest label among its neighbours and itself, and then the label of that label, so a
    label travels twice as far every round. Every round is stored in the shared folder. Sums at a crowded node are
    combined before the shuffle; rows with a crowded label meet only in inner joins, which Spark splits.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        new = nearer.join(jump, "mid").select("node", "old", F.least("mid", "far").alias("label"))
        moved = Observation()  # counted while the labels are stored
        labels = written(new.observe(moved, F.count_if(F.col("label") != F.col("old")).alias("n")), "labels").select("node", "label")
        if not moved.get["n"]:
            return labels
