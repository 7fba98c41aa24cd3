"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import Scratch


def star_components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v long); a component is its smallest node.

    A large-star step links every larger neighbour of a node with the least of its neighbourhood (itself
    included), a small-star step the node and its smaller neighbours. Both keep components whole. When two
    rounds give the same links, every node is linked with its component's least one alone. Least neighbours
    are found by a grouping and joined back, so no neighbourhood is gathered in a task, and joins with hot
    nodes can be split. Rounds grow with the logarithm of the longest path. Self-links are single nodes.
    """
    nodes = links.select(F.col("u").alias("node")).union(links.select("v")).distinct()
    nodes = scratch.settle(nodes, f"{name}-nodes")
    edges = scratch.settle(_sorted_edges(links), f"{name}-edges-0")
    before, turn = None, 0
    while True:
        turn += 1
        edges = scratch.settle(_small_star(_large_star(edges)), f"{name}-edges-{turn}")
        scratch.drop(f"{name}-edges-{turn - 1}")
        # count and sums of hashes: the links of two rounds are equal
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    least = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    out = scratch.settle(nodes.join(least, "node", "left").select("node", F.coalesce("component", "node").alias("component")), name)
    scratch.drop(f"{name}-edges-{turn}", f"{name}-nodes")
    return out


def _sorted_edges(links: DataFrame) -> DataFrame:
    """Every link once, the larger node first, without self-links."""
    return links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node go to the least of it and its neighbours."""
    both = edges.select("u", "v").union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return _sorted_edges(edges.select(F.col("u").alias("far"), F.col("v").alias("u")).join(least, "u").select(F.col("far").alias("u"), F.col("low").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("low"))
    moved = edges.join(least, "u")
    return _sorted_edges(moved.select(F.col("v").alias("u"), F.col("low").alias("v")).union(least.select("u", F.col("low").alias("v"))))
