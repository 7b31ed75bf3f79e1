"""Connected components of an edge table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def connected_components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` long edges -> ``(node, label)``, the label being the smallest
    node that can be reached.

    Each round hooks every root to its smallest neighbour, shortens the paths
    twice, and keeps the edges that still join two roots; the edge table shrinks
    until none is left. Neighbours are reduced by ``min`` before the shuffle, so
    a node with very many edges costs no more than its map tasks; joins on such
    a node are left to AQE, which splits them. Nulls and loops are dropped,
    repeated edges count once, and no edges give no rows."""
    live = checkpointed(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a != b")
        .select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b"))
        .distinct()
    )
    labels = live.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("label"))
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("p")).select(F.col("a").alias("n"), "p")
        for _ in range(2):
            up = parent.select(F.col("n").alias("p"), F.col("p").alias("q"))
            parent = parent.join(up, "p").select("n", F.col("q").alias("p"))
            parent = checkpointed(parent)
        labels = checkpointed(
            labels.join(parent, F.col("label") == F.col("n"), "left")
            .select("node", F.coalesce("p", "label").alias("label"))
        )
        pa, pb = (parent.select(F.col("n").alias(c), F.col("p").alias(f"p{c}")) for c in "ab")
        live = checkpointed(
            live.join(pa, "a").join(pb, "b").where("pa != pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        )
    return labels
