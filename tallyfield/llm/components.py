"""Connected components of an undirected graph by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import checkpoint


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge to another node; root is one node of its component.

    ``edges`` has the columns a and b, of one type with an order. Loops, repeated edges, edges
    given both ways and rows with a null are fine; they say nothing. An empty table gives an
    empty table.

    Each round hooks every node with a smaller neighbour to the smallest one, shortens the
    hooks until they point at roots, and renames the edges to roots. Edges within one root
    vanish, so few rounds remain. All steps are joins and aggregates; the driver sees counts.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")

    def tidy(df: DataFrame) -> DataFrame:
        known = df.where(F.col("a").isNotNull() & F.col("b").isNotNull())
        return checkpoint(known.select(low, high).where("a < b").distinct())

    edges = tidy(edges)
    labels = None
    while not edges.isEmpty():
        parents = _roots(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")))
        if labels is None:
            seen = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
            labels = checkpoint(_renamed(seen.withColumn("root", F.col("node")), "root", parents))
        else:
            labels = checkpoint(_renamed(labels, "root", parents))
        edges = tidy(_renamed(_renamed(edges, "a", parents), "b", parents))
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


def _renamed(df: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    to = parents.select(F.col("node").alias(column), F.col("root").alias("_to"))
    joined = df.join(to, column, "left")
    return joined.withColumn(column, F.coalesce("_to", column)).drop("_to").select(*df.columns)


def _roots(hooks: DataFrame) -> DataFrame:
    """Follow the hooks (node to a smaller node) by doubling until all end at a root."""
    hooks = checkpoint(hooks)
    while True:
        up = hooks.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        longer = hooks.join(up, "root", "left").select(
            "node", F.coalesce("_up", "root").alias("root"), F.col("_up").isNotNull().alias("_moved")
        )
        longer = checkpoint(longer)
        hooks = longer.drop("_moved")
        if longer.where("_moved").isEmpty():
            return hooks
