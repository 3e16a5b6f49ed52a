"""Connected components of an edge table, by contraction.

Each round every node takes the smallest node next to it as its parent, parents are followed twice, and the edges are drawn
anew between what is left; edges inside one tree vanish.  A star of any size is gone after one round and a chain loses more
than half of its nodes in each.  Edges, labels and components stay distributed: only the question whether an edge is left
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame, *, src: str = "u", dst: str = "v") -> DataFrame:
    """node, component (the smallest node that is reachable) for every node of an edge.

    Edges with a null end and loops are left out; repeated edges and either direction are fine; without edges the result is
    empty.  Nodes may be of any type that orders.
    """
    a, b = F.col(src), F.col(dst)
    left = stored(edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct(), "edges")
    labels = None
    while not left.isEmpty():
        both = left.select("u", "v").union(left.select(F.col("v"), F.col("u")))
        parent = stored(both.groupBy("u").agg(F.min("v").alias("p")).select(F.col("u").alias("node"), F.least("u", "p").alias("p")), "parents")
        up = parent.select(F.col("node").alias("n2"), F.col("p").alias("p2"))
        # node -> parent -> grandparent; a parent is a node of an edge itself.
        parent = stored(parent.join(up, parent.p == up.n2).select("node", F.col("p2").alias("p")), "parents")
        to = lambda c: parent.select(F.col("node").alias(f"n_{c}"), F.col("p").alias(f"p_{c}"))
        drawn = left.join(to("u"), F.col("u") == F.col("n_u")).join(to("v"), F.col("v") == F.col("n_v"))
        moved = drawn.where("p_u <> p_v").select(F.least("p_u", "p_v").alias("u"), F.greatest("p_u", "p_v").alias("v"))
        # A node keeps an edge to its parent where the parent is still to be moved.
        if labels is None:
            labels = parent.select("node", F.col("p").alias("component"))
        else:
            labels = labels.join(to("c"), F.col("component") == F.col("n_c"), "left").select("node", F.coalesce("p_c", "component").alias("component"))
        labels, left = stored(labels, "labels"), stored(moved.distinct(), "edges")
    if labels is None:
        return left.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels
