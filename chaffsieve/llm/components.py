"""Connected components of a link table, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chaffsieve.sources.staging import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))


def _is_star(edges: DataFrame) -> bool:
    """Does every node hang on one lower node that hangs on none?"""
    nodes = edges.select(F.col("high").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    nodes = nodes.union(edges.select("low", F.lit(0), F.lit(1)))
    wrong = nodes.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not wrong.filter("up > 1 OR (up = 1 AND down = 1)").take(1)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node that is not its component's smallest.

    ``links`` has columns a and b.  Each round joins neighbours to the
    smallest node around them, first the larger neighbours, then the smaller
    ones; chains shrink to a fraction per round.  A node's neighbours are
    never gathered: only their minimum is, and a join on it, which adaptive
    execution splits for a node with very many links.  Every round is written
    out, so lineage stays short.  Self-links and NULLs are ignored.
    """
    edges = links.filter("a <> b").select(
        F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    )
    edges = stage(edges.distinct(), "links")
    while not _is_star(edges):
        both = _both_ways(edges)
        around = stage(both.groupBy("high").agg(F.min("low").alias("near")), "nearest")
        around = around.select(
            F.col("high").alias("hub"), F.least("high", "near").alias("lowest")
        )
        large = both.withColumnsRenamed({"high": "hub", "low": "other"}).join(around, "hub")
        large = large.filter("other > hub AND other <> lowest").select(
            F.col("other").alias("high"), F.col("lowest").alias("low")
        )
        large = stage(large.distinct(), "large-star")
        below = stage(large.groupBy("high").agg(F.min("low").alias("lowest")), "lowest")
        small = large.join(below, "high").filter("low <> lowest").select(
            F.col("low").alias("high"), F.col("lowest").alias("low")
        )
        small = small.union(below.select("high", F.col("lowest").alias("low")))
        edges = stage(small.distinct(), "small-star")
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
