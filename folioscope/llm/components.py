"""Connected components of a link table by hooking and shortcutting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v long); a component is its smallest node.

    Each round puts the larger of a link's two labels below the smaller one and replaces labels by
    their roots; the number of rounds grows with the logarithm of the longest path. All tables are
    written to the shared folder between steps, so joins read plain shuffles, whose hot keys
    adaptive execution can split; a step's inputs are deleted when it is written. The result is the table ``name``.
    """
    edges = scratch.settle(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-edges-0")
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    labels = scratch.settle(nodes.select("node", F.col("node").alias("component")), f"{name}-labels-0")
    turn = 0
    while True:
        here, there = labels.toDF("u", "lu"), labels.toDF("v", "lv")
        turn += 1
        edges = scratch.settle(
            edges.where("u <> v").join(here, "u").join(there, "v").where("lu <> lv")
            .select(F.greatest("lu", "lv").alias("u"), F.least("lu", "lv").alias("v")).distinct(), f"{name}-edges-{turn}",
        )
        scratch.drop(f"{name}-edges-{turn - 1}")
        if edges.isEmpty():
            out = scratch.settle(labels, name)
            scratch.drop(f"{name}-edges-{turn}", f"{name}-labels-{turn - 1}")
            return out
        parents = scratch.settle(edges.groupBy("u").agg(F.min("v").alias("parent")), f"{name}-parents-{turn}-0")
        parents = _roots(parents, scratch, f"{name}-parents-{turn}")
        labels = scratch.settle(
            labels.join(parents.withColumnRenamed("u", "component"), "component", "left")
            .select("node", F.coalesce("parent", "component").alias("component")), f"{name}-labels-{turn}",
        )
        scratch.drop(f"{name}-labels-{turn - 1}", f"{name}-parents-{turn}")


def _roots(parents: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(u, parent) with every parent replaced by the root of its chain."""
    step = 0
    while True:
        up = parents.select("u", "parent").toDF("parent", "above")
        step += 1
        stepped = scratch.settle(
            parents.join(up, "parent", "left").select("u", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")), f"{name}-{step}"
        )
        scratch.drop(f"{name}-{step - 1}")
        parents = stepped.select("u", "parent")
        if not stepped.where("moved").limit(1).count():
            out = scratch.settle(parents, name)
            scratch.drop(f"{name}-{step}")
            return out
