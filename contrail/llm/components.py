"""Connected components of an edge list by alternating large-star and small-star steps.

Every step is a grouped minimum and a join back, so no task holds the neighbours of a node. Each round
is written to the shared scratch folder, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import stash

MAX_ROUNDS = 100


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: hang the neighbours of each node on the smallest node among it and its neighbours."""
    if large:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stash(sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "cc-least")
    # written first: the join then stands alone, and Spark can split a node with very many neighbours
    hung = sides.join(least, "a")
    if large:
        out = hung.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) links of any orderable ids -> (node, root), root being the smallest id of the component.

    Nodes without links are not in the result, nor do links with a null end or from a node to itself
    count. The roots themselves are in it. No rows in, no rows out.
    """
    now = stash(edges.select("a", "b").filter("a <> b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    mark = None
    for _ in range(MAX_ROUNDS):
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark or seen[0] == 0:
            break
        mark = tuple(seen)
        now = stash(_star(stash(_star(now, large=True), "cc"), large=False), "cc")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return (now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
