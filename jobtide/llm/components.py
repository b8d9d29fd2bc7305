"""Connected components by hooking and pointer jumping.

Each node hooks to its least neighbour below it, which makes a forest; its roots come from pointer
jumping, where every round doubles the distance. Links between different trees go into the next
round with the roots in place of their nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import stored


def roots(parents: DataFrame) -> DataFrame:
    """(node, component): the root of each node of a forest (node, up), without the roots."""
    now = stored(parents.select("node", F.col("up").alias("component")), "forest")
    while True:
        above = now.select(F.col("node").alias("component"), F.col("component").alias("_far"))
        jumped = now.join(above, "component", "left")
        new = stored(jumped.select("node", F.coalesce("_far", "component").alias("component"),
                                   F.col("_far").isNotNull().alias("moved")), "forest")
        now = new.select("node", "component")
        if new.where("moved").isEmpty():
            return now


def relabelled(pairs: DataFrame, placed: DataFrame, names: list[str]) -> DataFrame:
    """Pairs with the component in place of each node of the named columns that has one."""
    for name in names:
        to = placed.select(F.col("node").alias(name), F.col("component").alias("_to"))
        pairs = pairs.join(to, name, "left").withColumn(name, F.coalesce("_to", name)).drop("_to")
    return pairs


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of undirected edges (a, b) of longs; the component is its
    least node. Least neighbours come from a grouping with partial results and go back by joins
    that Spark can split, so that a node with very many neighbours never meets in one task."""
    def directed(pairs: DataFrame) -> DataFrame:
        return stored(pairs.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")

    left, placed = directed(edges), None
    while not left.isEmpty():
        parents = left.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"), F.count("*").alias("n"))
        parents = stored(parents, "parents")
        found = roots(parents)
        placed = found if placed is None else stored(
            relabelled(placed, found, ["component"]).unionByName(
                found.join(placed.select("node"), "node", "left_anti")), "placed")
        if parents.where("n > 1").isEmpty():
            break
        left = directed(relabelled(left, found, ["a", "b"]))
    if placed is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    top = placed.select(F.col("component").alias("node"), "component").distinct()
    return placed.unionByName(top).select("node", "component")
