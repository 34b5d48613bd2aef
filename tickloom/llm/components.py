"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.sources import tables


def _least(edges: DataFrame) -> DataFrame:
    """(u, m): the least of each node u and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.where("v > u").join(_least(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge.

    Every round is two joins on equal keys with pre-aggregated minima, so a hub with very many
    neighbours is split like any skewed join. Each round is cut by a checkpoint in the shared folder,
    and rounds end when no edge changes; their number grows with the logarithm of the longest path.
    Self-links and repeated edges are allowed, nulls are no nodes. No edges give no rows.
    """
    nodes = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    loops = nodes.where("u = v").select("u").distinct()
    current = tables.cut_lineage(nodes.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == state or mark[0] == 0:
            break
        state = mark
        current = tables.cut_lineage(_small_star(_large_star(current).where("u <> v").distinct()).where("u <> v").distinct())
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    alone = loops.select(F.col("u").alias("node"), F.col("u").alias("component"))
    return stars.union(roots).union(alone).groupBy("node").agg(F.min("component").alias("component"))
