"""Connected components by distributed union-find, in native DataFrame operations.

Every node points to the smallest node it knows of.  A round lets each node take the
smallest pointer among its neighbours, lets the node pointed to take the smallest of those
that point to it, and shortens the pointers.  Only minima are aggregated (partially before
each shuffle), so a hub with any number of neighbours never meets in one task, and each
round's pointers are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import stash

MAX_ROUNDS = 200


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Repeated edges, either direction, and edges of a node with itself may occur; null ends
    are dropped; no edges give no rows.
    """
    one = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna()
    both = stash(one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v")))
                 .distinct(), "graph-edges")
    now = stash(both.groupBy("u").agg(F.min("v").alias("v"))
                .select(F.col("u").alias("node"), F.least("u", "v").alias("to")), "graph-0")
    for i in range(MAX_ROUNDS):
        near = (both.join(now.select(F.col("node").alias("v"), "to"), "v")
                .groupBy("u").agg(F.min("to").alias("near")))
        hooked = (now.join(near, now["node"] == near["u"])
                  .select("node", "to", F.least("to", "near").alias("new")))
        hooked = stash(hooked, f"graph-{i}-near")
        roots = hooked.groupBy(F.col("to").alias("root")).agg(F.min("new").alias("best"))
        moved = (hooked.join(roots, hooked["node"] == roots["root"], "left")
                 .select("node", F.least("new", "best").alias("to")))
        moved = stash(moved, f"graph-{i}-root")
        up = moved.select(F.col("node").alias("to"), F.col("to").alias("top"))
        after = stash(moved.join(up, "to").select("node", F.col("top").alias("to")),
                      f"graph-{i}")
        same = after.join(now.withColumnRenamed("to", "was"), "node").filter(
            F.col("to") != F.col("was")).limit(1).count() == 0
        now = after
        if same:
            return now.select("node", F.col("to").alias("component"))
    raise RuntimeError(f"no fixed point in {MAX_ROUNDS} rounds")
