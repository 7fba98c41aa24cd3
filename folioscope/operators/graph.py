"""Collaboration and overlap graphs as edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def coauthor_edges(authorships: DataFrame, item: str = "doi", member: str = "author") -> DataFrame:
    """(src, dst, weight) with src < dst: how many items two members share.

    An item's members are few, so the self join on the item is linear in practice; items are distinct first.
    """
    return edge_items(authorships, item, member).groupBy("src", "dst").agg(F.count("*").alias("weight"))


def degrees(edges: DataFrame) -> DataFrame:
    """(node, degree, strength)."""
    ends = edges.select(F.col("src").alias("node"), "weight").union(edges.select("dst", "weight"))
    return ends.groupBy("node").agg(F.count("*").alias("degree"), F.sum("weight").alias("strength"))


def edge_items(authorships: DataFrame, item: str = "doi", member: str = "author") -> DataFrame:
    """(src, dst, item) with src < dst: the items that make each edge, as rows; an edge can have any number of them."""
    pairs = authorships.select(item, member).distinct()
    a, b = pairs.toDF(item, "src"), pairs.toDF(item, "dst")
    return a.join(b, item).where("src < dst").select("src", "dst", item)


def edge_articles(authorships: DataFrame, item: str = "doi", member: str = "author") -> DataFrame:
    """Edges with the sorted items that make them as an array: the shape of stored records, for edges known to be small."""
    return edge_items(authorships, item, member).groupBy("src", "dst").agg(F.sort_array(F.collect_list(item)).alias("articles"))


def matrix(edges: DataFrame, nodes: list[str]) -> DataFrame:
    """A row per node and a column per node of a given short list."""
    both = edges.union(edges.select("dst", "src", "weight"))
    return both.groupBy("src").pivot("dst", nodes).sum("weight")
