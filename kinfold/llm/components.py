"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import written


def large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least node it knows."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of them."""
    down = edges.where("a > b").select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    moved = down.join(least, F.col("u") == F.col("w")).where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("w").alias("a"), F.col("m").alias("b"))).distinct()


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """node, component: the least node reachable, for every node of links (a, b) but the least.

    Both steps need grouped minima and equi-joins only: a node with very many links is spread
    over tasks. The rounds needed grow with the logarithm of the number of nodes; each is
    written, so that a lost executor costs one round. Self-links and repeats don't matter; no
    links give no rows.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    for _ in range(rounds):
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if mark["n"] == 0 or before == (mark["n"], mark["s"]):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = (mark["n"], mark["s"])
        edges = written(small_star(large_star(edges)), "links")
    raise RuntimeError(f"components have not settled in {rounds} rounds")
