"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Workspace


def components(edges: DataFrame, space: Workspace, name: str = "component") -> DataFrame:
    """(node, root) for every node of the edges (a, b), both long; root is the smallest node reachable.

    Each round gives a node the smallest label among its own and its neighbours', then the label of that label, so long
    chains shorten geometrically. Labels are written to the shared folder after every round and only a count of
    changes reaches the driver. Minima combine before they are shuffled; a node with very many edges is the skewed side
    of a sort-merge join, which adaptive execution splits. No edges give no rows.
    """
    linked = space.table(
        f"{name}-edges",
        edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        .select("e.a", "e.b")
        .where("a != b")
        .distinct(),
    )
    nodes = linked.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    labels = space.table(f"{name}-0", nodes.select("node", F.least("node", "near").alias("root")))
    for step in range(1, 100):
        near = linked.join(labels, linked["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near"))
        lowered = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("root").alias("was"), F.least("root", "near").alias("root")
        )
        jump = lowered.select(F.col("node").alias("root"), F.col("root").alias("further"))
        jumped = lowered.join(jump, "root").select("node", "was", F.least("root", "further").alias("root"))
        moved = space.table(f"{name}-{step}", jumped)
        changed = moved.where("was != root").limit(1).count()
        space.drop(f"{name}-{step - 1}")
        labels = moved.select("node", "root")
        if not changed:
            return labels
    raise RuntimeError("components did not settle")
