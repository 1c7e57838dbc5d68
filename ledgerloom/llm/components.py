"""Connected components of an edge table, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_ROUNDS = 60


def components(edges: DataFrame, keep) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node.

    Each round takes the smallest label among neighbours, then the label's label, so the
    distance covered about doubles. Labels of a round are written, which cuts lineage.
    """
    both = keep(
        edges.select("a", "b")
        .union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .filter("a IS NOT NULL AND b IS NOT NULL")
        .distinct(),
        "edges",
    )
    labels = keep(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.first("a"), F.min("b")).alias("root")
        ),
        "labels",
    )
    for _ in range(MOST_ROUNDS):
        near = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        closer = keep(
            labels.join(near, "node").select(
                "node", F.col("root").alias("was"), F.least("root", "near").alias("root")
            ),
            "closer",
        )
        jump = closer.select(F.col("node").alias("root"), F.col("root").alias("further"))
        jumped = keep(
            closer.join(jump, "root").select("node", "was", F.col("further").alias("root")),
            "labels",
        )
        labels = jumped.select("node", "root")
        if jumped.filter("was <> root").isEmpty():
            return labels
    raise RuntimeError("components did not settle")
