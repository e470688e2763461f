"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetymart.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (a, b); the smallest id names it.

    Each round every vertex points to its smallest neighbour, pointers are followed
    twice, and vertices are merged into what they point to. The rounds grow with
    the logarithm of the longest path. Every round is written to the shared folder;
    nothing but the number of edges left reaches the driver.
    """
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    edges = stored(edges.filter("a <> b").select(*pair).distinct(), "edges")
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.least("a", F.min("b")).alias("p"))
        near = stored(near, "near")
        up = near.select(F.col("a").alias("p"), F.col("p").alias("q"))
        over = up.select(F.col("p").alias("q"), F.col("q").alias("to"))
        target = near.join(up, "p").join(over, "q").select("a", "to")
        target = stored(target, "target")
        if labels is None:
            labels = target.select(F.col("a").alias("id"), F.col("to").alias("component"))
        else:
            moved = target.select(F.col("a").alias("component"), "to")
            labels = labels.join(moved, "component", "left").select(
                "id", F.coalesce("to", "component").alias("component")
            )
        end = target.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        merged = edges.join(target, "a").join(end, "b").filter("to <> to_b")
        edges = merged.select(F.least("to", "to_b").alias("a"), F.greatest("to", "to_b").alias("b"))
        edges = stored(edges.distinct(), "edges")
        if edges.isEmpty():
            return stored(labels, "labels")
