"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.sources.storage import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    moved = both.join(least, "u").where("v > u")
    return moved.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v != m")
    return (
        others.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of the edges (u, v) reaches.

    Each round is a written table, so its lineage ends there. Minima are taken
    before rows move, so a node with very many neighbours is one row for each
    task; loops and repeated edges change nothing, no edges give no rows.
    """
    oriented = edges.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    current = stored(oriented.distinct(), "components")
    mark = None
    while True:
        found = current.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if found == mark:
            break
        mark = found
        current = stored(_small_star(_large_star(current)), "components")
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
