"""Connected components of a graph given as edges, by smallest labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop_stored, stored


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node reachable) of every node of ``edges`` (a, b).

    Each round gives a node the smallest label of its neighbours and then that label's own label, so long chains shrink
    by half; it ends when no label changes. Every round is a table in the shared folder.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "edges")
    held = labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        new = stored(lower.join(jump, "low", "left").select(
            "node", "old", F.least("low", F.coalesce("far", "low")).alias("label")), "labels")
        drop_stored(held)
        held, labels = new, new.select("node", "label")
        if new.filter("old <> label").isEmpty():
            drop_stored(both)
            return labels
