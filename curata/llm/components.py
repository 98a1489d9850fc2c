"""Connected components of a distributed edge table by alternating large and small stars.

Every round hangs the neighbours of each node on its smallest neighbour, first those that are
larger than the node, then the node itself with the smaller ones.  The table never holds more than
one row per edge, all steps are joins and grouped minima, and each round is written to the shared
folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm.common import materialise


def _on_smallest(edges: DataFrame) -> DataFrame:
    """(a, b) -> (a, m) for the smallest b of each a; the minimum is combined before the shuffle."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a")


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star over edges (a, b) with a > b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = _on_smallest(both).filter("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")).filter("a > b").distinct()
    hung = _on_smallest(large)
    small = hung.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(hung.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node with an edge (a, b); component is its smallest reachable node."""
    oriented = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = materialise(oriented, name)
    before = _state(current)
    while before[0]:
        current = materialise(_round(current), name)
        now = _state(current)
        if now == before:
            break
        before = now
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
