"""Connected components of an edge table, as repeated joins on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a long, b long); the label is the least node reachable.

    Each round takes the least label among the neighbours and then the label's own label, so a chain
    of any length is followed in few rounds. Labels are written after each round: nothing grows with
    the number of rounds, and a lost executor costs one round at most. Edges may repeat. Without
    edges the result is empty.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a <> b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["a"] == labels["node"]).groupBy(F.col("b").alias("near")).agg(F.min("label").alias("least"))
        step = stored(
            labels.join(near, F.col("node") == F.col("near")).select(
                "node", F.col("label").alias("old"), F.least("label", "least").alias("label")
            ),
            "labels",
        )
        jump = step.select(F.col("node").alias("at"), F.col("label").alias("further"))
        moved = step.join(jump, step["label"] == jump["at"]).select("node", "old", F.col("further").alias("label"))
        moved = stored(moved, "labels")
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels
