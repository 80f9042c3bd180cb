"""Connected components by contraction, on tables that executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.runtime import durable


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) of every node of an edge; the component is its smallest node.

    In each round every node takes the smallest of itself and its neighbours as
    label, and edges are redrawn between labels. The graph shrinks until no edge
    is left; then the rounds' labels are followed from the first to the last.
    No task sees a whole component: a node with very many edges is folded to its
    smallest neighbour by partial aggregation. Each round is written, so lost
    executors don't bring back earlier ones. Edges with a null end are left out.
    """
    level = durable(
        edges.select(F.col(left).alias("a"), F.col(right).alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct(),
        "edges",
    )
    labels: DataFrame | None = None
    while labels is None or not level.isEmpty():
        nodes = durable(_smallest_neighbour(level), "labels")
        if labels is None:
            labels = nodes
        else:
            follow = nodes.select(F.col("node").alias("component"), F.col("component").alias("_next"))
            labels = durable(
                labels.join(follow, "component", "left").select(
                    "node", F.coalesce("_next", "component").alias("component")
                ),
                "labels",
            )
        level = durable(_contracted(level, nodes), "edges")
    return labels


def _smallest_neighbour(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        edges.select(F.col("b"), F.col("a"))
    )
    return ends.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("component"))


def _contracted(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    for end in ("a", "b"):
        names = nodes.select(F.col("node").alias(end), F.col("component").alias("_label"))
        edges = edges.join(names, end).withColumn(end, F.col("_label")).drop("_label")
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
