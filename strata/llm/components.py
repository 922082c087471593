"""Connected components by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Every
step is a minimum per node (combined before the shuffle) and a join, so no
task holds a node's neighbours; adaptive execution splits the join partitions
of a node with very many of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import written


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    Edges are undirected; loops, repeats and rows with a null end are
    ignored (a node that has only loops is not in the result). No edges give
    an empty table. Works for any type with an order.
    """
    down = (
        edges.where("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    down, seen = written(down, label), None
    while True:
        state = down.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return down.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                down.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = state
        down = written(_small_star(_large_star(down)), label)


def _large_star(down: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    least = (
        down.select(F.col("a").alias("u"), F.col("b").alias("v"))
        .unionByName(down.select(F.col("b").alias("u"), F.col("b").alias("v")))
        .groupBy("u")
        .agg(F.min("v").alias("m"))
    )
    return down.join(least, down.b == least.u).select("a", F.col("m").alias("b")).distinct()


def _small_star(down: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least.withColumnRenamed("a", "u"), down.a == F.col("u")).where("b != m")
    return (
        least.select("a", F.col("m").alias("b"))
        .unionByName(moved.select(F.col("b").alias("a"), F.col("m").alias("b")))
        .distinct()
    )
