"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); label is the smallest node reached.

    Each round takes the least label among a node and its neighbours (combined before the
    shuffle, so a hub costs one row a task) and then the label of that label; rounds are written
    to the shared folder, so lineage stays short and survives lost executors."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        up = step.select(F.col("node").alias("new"), F.col("new").alias("top"))
        step = written(step.join(up, "new", "left").select("node", F.col("label").alias("old"), F.least(
            "new", F.coalesce("top", "new")).alias("label")), "labels")
        changed = step.where("label != old").limit(1).count()
        labels = step.select("node", "label")
        if not changed:
            return labels
