"""Bounded traversal of a graph of edges (src, dst)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import cut


def reach(edges: DataFrame, start: DataFrame, depth: int) -> DataFrame:
    """Rows (node, depth): nodes within ``depth`` steps of the start nodes, each at its smallest distance.

    Each step is a join of the frontier with the edges and an anti join with what
    was seen, so cycles end; the lineage is cut after each step.
    """
    links = edges.select("src", "dst")
    frontier = start.select(F.col(start.columns[0]).alias("node")).distinct().withColumn("depth", F.lit(0))
    seen = frontier
    for d in range(1, depth + 1):
        step = frontier.select(F.col("node").alias("src")).join(links, "src").select(F.col("dst").alias("node")).distinct()
        frontier = cut(step.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(d)))
        if not frontier.limit(1).count():
            break
        seen = cut(seen.union(frontier))
    return seen
