"""Connected components of an edge table: every node takes the smallest node it can reach.

Rounds of "hook and halve" on grouped minima.  In a round each node of the
contracted graph hooks to its smallest neighbour below it, chains of hooks are
halved until they are flat, and the edges are rewritten between the roots;
two rounds at least halve the nodes that still have edges.  A node's
neighbours never meet in one task: minima are combined before the shuffle.
Tables are written once a round, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.session import materialise


def _flatten(hooks: DataFrame) -> DataFrame:
    """(node, root) with every root a node that hooks nowhere: pointers are doubled until nothing moves."""
    while True:
        up = hooks.select(F.col("node").alias("__n"), F.col("root").alias("__up"))
        step = hooks.join(up, F.col("root") == F.col("__n"), "left")
        moved = materialise(step.select("node", F.coalesce("__up", "root").alias("root"), F.col("__up").isNotNull().alias("__moved")), "hooks")
        hooks = moved.drop("__moved")
        if moved.where("__moved").isEmpty():
            return hooks


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has an edge to another; ``component`` is the smallest node reachable.

    The node columns are LONG; rows with a null and loops are ignored.  An
    empty table gives no rows.
    """
    both = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    edges = materialise(both.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "edges")
    nodes = None
    while not edges.isEmpty():
        # every node with a smaller neighbour hooks to the smallest of them: no cycles
        hooks = _flatten(materialise(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")), "hooks"))
        if nodes is None:
            roots = edges.select(F.col("v").alias("node")).join(hooks, "node", "left_anti").distinct()
            nodes = materialise(hooks.unionByName(roots.withColumn("root", F.col("node"))), "nodes")
        else:
            known = hooks.select(F.col("node").alias("__n"), F.col("root").alias("__up"))
            nodes = materialise(nodes.join(known, F.col("root") == F.col("__n"), "left")
                                .select("node", F.coalesce("__up", "root").alias("root")), "nodes")
        for end in ("u", "v"):
            known = hooks.select(F.col("node").alias("__n"), F.col("root").alias("__up"))
            edges = edges.join(known, F.col(end) == F.col("__n"), "left").withColumn(end, F.coalesce("__up", end)).drop("__n", "__up")
        edges = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "edges")
    if nodes is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.select("node", F.col("root").alias("component"))
