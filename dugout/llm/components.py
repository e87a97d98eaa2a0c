"""Connected components of a link table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for all nodes of ``links`` (a, b); the label is the smallest node of the component.

    Each round takes the smallest label among the neighbours and then the label of that label, so long chains
    shrink by doubling.  Every round is written to the shared folder; only whether something changed comes back.
    """
    edges = materialise(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = materialise(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("n")).select("node", F.least("node", "n").alias("label")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        closer = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        closer = materialise(closer, "closer")
        jump = closer.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        labels = closer.join(jump, "label").select("node", "was", F.least("label", "jump").alias("label"))
        labels = materialise(labels, "labels")
        changed = labels.filter("label <> was").limit(1).count()
        labels = labels.drop("was")
        if not changed:
            return labels
