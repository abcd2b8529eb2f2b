"""Connected components by contraction, for graphs that fit no single machine.

Every round each component picks its smallest neighbour as parent, parents are shortened by pointer jumping, and the edges are rewritten
between the shortened parents; edges inside a component vanish. Rounds needed grow with the logarithm of the longest path. All groupings are
minimums and distincts, which combine before the shuffle, so a node with a third of all edges is no hot task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.plans.scratch import Scratch


def star_edges(links: DataFrame, member: str, hub: str) -> DataFrame:
    """Edges (u, v) that join every member of a hub to the hub's smallest member: as many edges as links, never all pairs.

    Rows with a null member or hub give no edge. Members are BIGINT.
    """
    links = links.select(F.col(member).alias("m"), F.col(hub).alias("h")).where("m is not null and h is not null")
    least = links.groupBy("h").agg(F.min("m").alias("v"))
    return links.join(least, "h").where("m <> v").select(F.col("m").alias("u"), "v").distinct()


def connected_components(edges: DataFrame, scratch: Scratch, jumps: int = 2, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node with an edge to another node; the component is the smallest node in it.

    ``edges`` has BIGINT columns u and v; direction, repeats and loops (u = v) do not matter, rows with a null are ignored. Nodes without
    an edge to another node are not returned (each is its own component). An empty table gives an empty table.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u is not null and v is not null and u <> v").distinct()
    e = scratch.write(e, "edges")
    labels = None
    for _ in range(max_rounds):
        if e.isEmpty():
            break
        parent = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("parent"))
        first = parent = scratch.write(parent, "parents")
        for _ in range(jumps):
            up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
            parent = parent.join(up, "parent", "left").select("node", F.coalesce("next", "parent").alias("parent"))
        parent = scratch.write(parent, "parents")
        scratch.drop(first)
        if labels is None:
            # every node of the graph: those with a parent, and the local minima
            roots = e.select(F.col("v").alias("node")).distinct().join(parent, "node", "left_anti").select("node", F.col("node").alias("component"))
            new = parent.select("node", F.col("parent").alias("component")).unionByName(roots)
        else:
            step = parent.select(F.col("node").alias("component"), "parent")
            new = labels.join(step, "component", "left").select("node", F.coalesce("parent", "component").alias("component"))
        new = scratch.write(new, "labels")
        scratch.drop(labels)
        labels = new
        pu = parent.select(F.col("node").alias("u"), F.col("parent").alias("pu"))
        pv = parent.select(F.col("node").alias("v"), F.col("parent").alias("pv"))
        after = e.join(pu, "u", "left").join(pv, "v", "left").select(F.coalesce("pu", "u").alias("a"), F.coalesce("pv", "v").alias("b")).where("a <> b")
        after = scratch.write(after.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
        scratch.drop(e)
        scratch.drop(parent)
        e = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    if labels is None:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels
