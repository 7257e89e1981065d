"""Mappings, groups and degrees on label graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.components import components_of_edges, connected_components
from gridloom.operators.lineage import cut


def mapping_from_edges(edges: DataFrame, identity: bool = True) -> DataFrame:
    """(segment, body): every node of an edge and the least node that it reaches; without identity, only nodes that move."""
    every = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    out = connected_components(every, edges).select(F.col("node").alias("segment"), F.col("component").alias("body"))
    return out if identity else out.where("segment <> body")


def groups_from_mapping(mapping: DataFrame) -> DataFrame:
    """(body, members): sorted lists. A group is one row, as its readers need."""
    return mapping.groupBy("body").agg(F.array_sort(F.collect_list("segment")).alias("members"))


def mapping_from_groups(groups: DataFrame) -> DataFrame:
    return groups.select(F.explode("members").alias("segment"), "body")


def component_sizes(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy("body").agg(F.count("*").alias("size"))


def edges_of_group(edges: DataFrame, node: int) -> DataFrame:
    """Edges of the component that holds a node."""
    found = cut(mapping_from_edges(edges))
    body = found.where(F.col("segment") == node).select("body")
    members = found.join(F.broadcast(body), "body", "left_semi").select(F.col("segment").alias("src"))
    return edges.join(members, "src", "left_semi")


def degrees(edges: DataFrame) -> DataFrame:
    """Number of distinct neighbours of each node."""
    both = edges.where("src <> dst").select("src", "dst").union(edges.where("src <> dst").select("dst", "src")).distinct()
    return both.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree"))


def leaf_nodes(edges: DataFrame) -> DataFrame:
    return degrees(edges).where("degree = 1").select("node")


def leaf_nodes_of_group(edges: DataFrame, node: int) -> DataFrame:
    return leaf_nodes(edges_of_group(edges, node))


def erode_leaves(edges: DataFrame, rounds: int = 1) -> DataFrame:
    """Edges without those of leaves, so many times over: each round looks at what the last one left."""
    for _ in range(rounds):
        leaves = leaf_nodes(edges)
        edges = cut(edges.join(leaves.select(F.col("node").alias("src")), "src", "left_anti").join(leaves.select(F.col("node").alias("dst")), "dst", "left_anti").select("src", "dst"))
    return edges


def split_disconnected(members: DataFrame, edges: DataFrame, next_body: int) -> DataFrame:
    """(segment, body) of a mapping whose bodies' segments the edges leave apart: pieces without the body's least segment get new bodies from next_body on."""
    from gridloom.operators.numbering import number_rows

    m = members.select("segment", "body")
    e = edges.join(m.select(F.col("segment").alias("src"), F.col("body").alias("_a")), "src").join(m.select(F.col("segment").alias("dst"), F.col("body").alias("_b")), "dst").where("_a = _b").select("src", "dst")
    found = cut(connected_components(m.select(F.col("segment").alias("node")), e).withColumnRenamed("node", "segment").join(m, "segment"))
    first = found.groupBy("body").agg(F.min("component").alias("component")).withColumn("_main", F.lit(True))
    extra = found.select("body", "component").distinct().join(first, ["body", "component"], "left_anti")
    new = number_rows(extra, ["body", "component"], "_new", next_body)
    return found.join(new, ["body", "component"], "left").select("segment", F.coalesce("_new", "body").alias("body"))


def stitch(parts: DataFrame, links: DataFrame) -> DataFrame:
    """(part, body): parts of neighbouring bricks that the links join, under the least part."""
    found = components_of_edges(links, "a", "b")
    return parts.select("part").distinct().join(found, F.col("part") == F.col("node"), "left").select("part", F.coalesce("component", "part").alias("body"))


def weighted_graph(elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges with summed weights, from elements (v1, v2, weight) in which v2 = -1 marks a vertex."""
    total = elements.groupBy("v1", "v2").agg(F.sum("weight").alias("weight"))
    return total.where("v2 = -1").select(F.col("v1").alias("vertex"), "weight"), total.where("v2 <> -1")
