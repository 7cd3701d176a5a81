"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.storage import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b): the smallest node that links reach.

    Each round takes the smallest label among neighbours and then the label of that label,
    so long chains shorten by halves. Every round is stored, which cuts its lineage.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("root").alias("further"))
        new = materialize(step.join(jump, "label").select("node", "old", F.least("label", "further").alias("root")), "labels")
        if new.filter("old <> root").isEmpty():
            return new.select("node", "root")
        labels = new.select("node", "root")
