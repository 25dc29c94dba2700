"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netquill.llm.common import discard, written


def _star(both: DataFrame, keep: str) -> tuple[DataFrame, DataFrame]:
    """For each node u with neighbours v in ``both`` (u, v): link the v that ``keep`` selects, and u
    itself in the small star, to the smallest of u and its neighbours. Also the table of the smallest."""
    least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "components_min")
    return both.join(least, "u").filter(keep).select(F.col("v").alias("u"), F.col("m").alias("v")), least


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), where root is the smallest node reachable.

    Every step links nodes to smaller ones and keeps connectivity; it ends when the edges are stars.
    Each step is a map-side combined minimum and an equi-join, so a node with very many neighbours is
    split by the engine; nothing is gathered per node.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v")
    for _ in range(max_rounds):
        mirrored = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        star, least = _star(mirrored, "v > u")
        large = written(star, "components_large")
        # every edge of the large star already points to a smaller node
        star, low = _star(large, "true")
        small = star.unionByName(large.groupBy("u").agg(F.min("v").alias("v")))
        before, now = now, written(small.filter("u != v").distinct(), "components_edges")
        discard(least, low, large, *([before] if hasattr(before, "written_to") else []))
        # stars: no node that others point to points on
        if now.select("v").join(now.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError(f"components not stable after {max_rounds} rounds")
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
