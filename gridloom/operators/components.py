"""Connected components by alternating large and small stars.

Each round links every node's larger neighbours to its smallest one (large star), then its smaller neighbours and
itself to the smallest (small star), until the edges no longer change and each component is a star around its least
node. A round is a few aggregates and joins on nodes; a node with very many neighbours is summed before the shuffle
and its rows are split by AQE in the joins. The edges of each round are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.lineage import cut_and_sum, forget


def _written(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The edges in the shared folder, with a checksum taken while they are written."""
    out, seen = cut_and_sum(edges, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"))
    return out, (seen["n"], seen["h"] or 0)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("w"), "m")
    moved = edges.join(least, F.col("a") == F.col("w")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("w").alias("a"), F.col("m").alias("b"))).distinct()


def components_of_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for each node that has an edge to another; component is the least node that can be reached."""
    known = edges.where(F.col(src) != F.col(dst)).select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).distinct()
    stars, state = _written(known)
    while True:
        new, found = _written(_small_star(_large_star(stars)))
        forget(stars)
        stars = new
        if found == state:
            break
        state = found
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def extended(components: DataFrame, edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """`components`, as `components_of_edges` gives them, after further edges: those are searched between components only."""
    known = components.select(F.col("node").alias("_node"), F.col("component").alias("_top"))
    ends = edges.select(F.col(src).alias("_a"), F.col(dst).alias("_b"))
    for end in ("_a", "_b"):
        ends = ends.join(known, F.col(end) == F.col("_node"), "left").withColumn(end, F.coalesce("_top", end)).drop("_node", "_top")
    joined = components_of_edges(ends, "_a", "_b").select(F.col("node").alias("_root"), F.col("component").alias("_least"))
    old = components.join(joined, F.col("component") == F.col("_root"), "left").select("node", F.coalesce("_least", "component").alias("component"))
    new = joined.join(known, F.col("_root") == F.col("_node"), "left_anti").select(F.col("_root").alias("node"), F.col("_least").alias("component"))
    return old.unionByName(new)


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "node", src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node, alone ones included."""
    found = components_of_edges(edges, src, dst).withColumnRenamed("node", "_n")
    every = nodes.select(F.col(node).alias("node")).distinct()
    return every.join(found, F.col("node") == F.col("_n"), "left").select("node", F.coalesce("component", "node").alias("component"))
