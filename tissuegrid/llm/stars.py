"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissuegrid.runtime import cut_lineage

#: The steps need about log^2 n rounds; a run that is not done after so many is an error, never a short answer.
MOST_ROUNDS = 100


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours on the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = cut_lineage(_smallest(both))  # written, so that the join below reads two plain tables and can split a hot node
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hangs its smaller neighbours and itself on the smallest of them. Edges come as u > v."""
    least = cut_lineage(_smallest(edges))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.where("u <> m").select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with an edge to another node; component is the smallest node of its part.

    Edges have no direction; nulls, loops and repeated edges are passed over; no edges give an empty table. Nodes may
    be of any type that has an order. Rounds go on until the edges are stars, which is tested exactly.
    """
    edges = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = cut_lineage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    for _ in range(MOST_ROUNDS):
        twice = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
        deep = edges.select("u").join(edges.select(F.col("v").alias("u")), "u", "left_semi")
        if twice.unionByName(deep).isEmpty():
            break
        edges = cut_lineage(_small_star(cut_lineage(_large_star(edges))))
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
