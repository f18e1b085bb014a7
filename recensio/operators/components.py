"""Connected components by min-label hooking and pointer jumping.

After Zhang, Azad and Hu (2020): every round hooks a node and its parent to the
smallest grandparent among the neighbours, so the number of rounds grows with
the logarithm of the longest chain and not with its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recensio.session import materialize

#: Tables of so many nodes are broadcast; of more, rounds shuffle them. Edges, which are many more, never pass the driver.
DRIVER_NODES = 20_000


def by_nodes(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a row per node of ``rows`` at most, with a hint on how to join it."""
    return df.hint("merge") if rows > DRIVER_NODES else F.broadcast(df)


def connected_components(nodes: DataFrame, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)``; the component is its smallest node.

    ``nodes(node)``, ``edges(a, b)`` in one direction. Both sides of each
    aggregation are minima, combined before the shuffle, so a parent shared by
    very many nodes costs one row per task.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both)
    kind = dict(nodes.dtypes)["node"]
    parents = materialize(nodes.select("node", F.col("node").alias("parent")))
    size = parents.count()
    for _ in range(rounds):
        lifted = parents.join(
            by_nodes(parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand")), size), "parent"
        ).select("node", "parent", "grand")
        nearest = (
            both.join(by_nodes(lifted.select(F.col("node").alias("b"), "grand"), size), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("grand").alias("near"))
        )
        hooked = lifted.join(by_nodes(nearest, size), "node", "left").select(
            "node", "parent", F.least("parent", "grand", F.coalesce("near", "grand")).alias("low")
        )
        proposals = hooked.select("node", "low", F.col("parent").alias("old")).union(
            hooked.select("parent", "low", F.lit(None).cast(kind))
        )
        # what a parent was before rides along, so the end shows without another join
        updated = materialize(proposals.groupBy("node").agg(F.min("low").alias("parent"), F.max("old").alias("old")))
        parents = updated.select("node", "parent")
        if updated.filter(F.col("parent") != F.col("old")).isEmpty():
            return parents.select("node", F.col("parent").alias("component"))
    raise RuntimeError(f"components did not settle in {rounds} rounds")
