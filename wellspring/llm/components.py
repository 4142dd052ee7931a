"""Connected components of a link table by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.shared import Workspace


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()
    return row[0], row[1]


def components(links: DataFrame, work: Workspace, name: str) -> DataFrame:
    """(node, root) for every node of links(a, b); root is the component's smallest node.

    Both stars only move edges towards smaller nodes, so the loop ends, after a
    number of rounds about logarithmic in the longest path. Each round is a
    map-side-combined minimum and one join, written so that lineage stays short.
    """
    edges = work.write(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0"
    )
    mark, step = _mark(edges), 0
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        step += 1
        edges = work.write(small.where("u <> v").distinct(), f"{name}-{step}")
        work.drop(f"{name}-{step - 1}")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
