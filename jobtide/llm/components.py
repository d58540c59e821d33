"""Connected components of a graph given as an edge table, by repeated contraction.

In each round every node takes the smallest node among itself and its neighbours as parent, the
edges move to the parents, and edges inside a parent disappear.  While this takes away a quarter of the edges or more, it
goes on so.  From the first round that takes less (chains whose names rise lose one link a round), parents are followed up to
the root of their tree before the edges move.  A root is smaller than all its neighbours.  Of a root that no node has taken as
parent, a neighbour has taken a smaller node, so it is no root in the next round: with every two such rounds at least half of
the nodes go.  The way up is halved by every join.  So rounds grow with the logarithm of the graph, whatever the order of its names.

Each step's tables are written to the shared folder, so the lineage
stays short and the joins are planned with known sizes; a node with very many edges is a skewed join key
that adaptive execution splits, and its minimum is reduced before the shuffle.
Nothing but one row count per round reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from jobtide.llm.tables import stored


def _roots(parent: DataFrame, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """(node, parent) with the root of each node's tree as parent."""
    while True:
        above = parent.toDF("parent", "grand")
        moved = (F.col("grand") != F.col("parent")).alias("moved")
        jumped = store(parent.join(above, "parent").select("node", F.col("grand").alias("parent"), moved), "jumps")
        parent = jumped.select("node", "parent")
        if jumped.where("moved").isEmpty():
            return parent


def connected_components(
    edges: DataFrame, a: str = "a", b: str = "b", store: Callable[[DataFrame, str], DataFrame] = stored
) -> DataFrame:
    """(node, component) for every node that has an edge to another; component is its smallest node.

    Edges with a null end and edges from a node to itself are passed over; repeated edges and
    either direction count alike.  ``store`` writes a table and reads it back.
    """
    one = edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    left = store(one, "edges")
    labels, count, close = None, left.count(), False
    while True:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        parent = store(parent.select("node", F.least("node", "parent").alias("parent")), "parents")
        if close:
            parent = _roots(parent, store)
        if labels is None:
            labels = parent.select("node", F.col("parent").alias("component"))
        else:
            moved = labels.join(parent.withColumnRenamed("node", "component"), "component", "left")
            labels = store(moved.select("node", F.coalesce("parent", "component").alias("component")), "labels")
        low, high = parent.toDF("a", "pa"), parent.toDF("b", "pb")
        moved = left.join(low, "a").join(high, "b").where("pa != pb")
        left = store(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        before, count = count, left.count()
        if count == 0:
            return labels
        close = close or 4 * count > 3 * before
