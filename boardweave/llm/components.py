"""Connected components by alternating large and small stars.

A step gives every node's neighbours to the least of them. Least neighbours
are found by an aggregation that combines on the map side; the join that
brings them back has two plain exchanges, so that adaptive execution splits a
hub's partition. Steps are written tables, hence lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from boardweave.llm.batches import written


def _with_least(edges: DataFrame, small: bool) -> DataFrame:
    """(u, v) with the least neighbour m of u, u itself included."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    if small:  # sent to every executor, so that the edges stay where they are
        least = F.broadcast(least.select(F.col("u").alias("w"), F.least("m", "u").alias("m")))
        return edges.join(least, F.col("u") == F.col("w")).select("u", "v", "m")
    # The name for u is an expression: the join then deals this side anew and may split hubs.
    least = least.select(F.bitwise_not(F.bitwise_not("u")).alias("w"), F.least("m", "u").alias("m"))
    return edges.join(least, F.col("u") == F.col("w")).select("u", "v", "m")


def _large_star(edges: DataFrame, small: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both, small).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, small: bool) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _with_least(down, small)
    moved = near.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(near.select("u", F.col("m").alias("v")))


def components(links: DataFrame, few: int = 0) -> DataFrame:
    """Links (u, v) of longs -> (node, root): the least node reachable, for every node with a link to another.

    While there are at most ``few`` links, their least neighbours are broadcast.
    """
    edges = written(links.select("u", "v").where("u != v").distinct(), "links")
    small = bool(few) and edges.count() <= few  # no step has more edges than the one before
    before = None
    while True:
        now = Observation()
        stars = _small_star(_large_star(edges, small), small).where("u != v").distinct()
        edges = written(stars.observe(now, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")), "stars")
        if now.get == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now.get
