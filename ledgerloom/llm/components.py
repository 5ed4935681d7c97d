"""Connected components of a graph too large for one machine.

Alternating large-star and small-star steps (Kiveris et al., 2014): each step points a node's
neighbours at the smallest node it knows, and after a logarithmic number of rounds every
component is a star around its smallest node.  Steps are minimum aggregates and joins, so a node
with very many neighbours is combined before the shuffle and split by the adaptive skew join.
Each round is written to the shared folder; only one count reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import let_go, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one parent at most and no parent has one itself."""
    one, none = F.lit(1).alias("up"), F.lit(0).alias("up")
    ends = edges.select(F.col("u").alias("node"), one).unionByName(edges.select(F.col("v").alias("node"), none))
    seen = ends.groupBy("node").agg(F.sum("up").alias("parents"), F.min("up").alias("own"))
    open_nodes = seen.agg(F.count_if((F.col("parents") > 1) | ((F.col("parents") > 0) & (F.col("own") == 0))))
    return open_nodes.first()[0] == 0


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node of ``links (a, b)``; ``component`` is its smallest node.

    Rows with a null end and links of a node with itself are left out; an empty table gives an
    empty result.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(_small_star(edges), "links")
    while not _is_stars(edges):
        edges = stored(_small_star(_large_star(edges)), "links")
        let_go(edges.sparkSession)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
