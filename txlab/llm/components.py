"""Connected components of a link table, by union-find over DataFrames.

Every node points to the smallest neighbour it knows (hooking), and pointers
are shortened until each points at the smallest node of its component (path
compression). One round is two aggregations and two joins on the links, which
never leave the executors; links shrink to one per node. Least neighbours are
written before they are joined, so that a hub's links can be split. Rounds grow with the
logarithm of the longest chain, not with the number of links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlab.sources.staging import stage


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _hook_large(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node go to the smallest node around it."""
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("n")).union(
        edges.select(F.col("v").alias("x"), F.col("u").alias("n"))
    )
    least = stage(both.groupBy("x").agg(F.min("n").alias("m")))
    return (
        both.join(least, "x")
        .filter(F.col("n") > F.col("x"))
        .select(F.col("n").alias("u"), F.least("x", "m").alias("v"))
        .distinct()
    )


def _hook_small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of them."""
    least = stage(edges.groupBy("u").agg(F.min("v").alias("m")))
    moved = (
        edges.join(least, "u")
        .filter(F.col("v") != F.col("m"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node that has a link and isn't the smallest of its component.

    ``links`` has two columns of ids in any order, repeated or not. A link of a
    node with itself, or with a missing id, is left out. A node that is not in
    the result is its own component. No links give no rows.
    """
    a, b = links.columns
    edges = stage(
        links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    seen = _signature(edges)
    while seen[0]:
        edges = stage(_hook_small(_hook_large(edges)))
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
