"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import landed


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) to (node, label), the label being the least node of the component.

    Labels pass along edges, then each node takes its label's label; with that a chain shrinks by half
    in a round. Only a count comes to the driver. Every round is written to the shared scratch folder.
    """
    both = landed(
        edges.select("a", "b").union(edges.select("b", "a")).distinct().where("a != b"), "edges"
    )
    labels = landed(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")),
        "labels",
    )
    while True:
        heard = (
            both.join(labels, both.b == labels.node)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("heard"))
        )
        nearer = labels.join(heard, "node").select(
            "node", F.least("label", "heard").alias("label"), F.col("label").alias("before")
        )
        nearer = landed(nearer, "labels")
        jump = nearer.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = landed(
            nearer.join(jump, "label").select("node", F.col("further").alias("label"), "before"),
            "labels",
        )
        if labels.where("label != before").isEmpty():
            return labels.select("node", "label")
