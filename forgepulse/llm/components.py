"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.common import stored


def large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to its smallest neighbour, itself included."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    neighbours = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return neighbours.union(least.select("u", "m")).toDF("u", "v").distinct()


def component_labels(links: DataFrame) -> DataFrame:
    """(node, label) for every node that has a link; the label is its component's least node.

    `links` has columns u and v, in any order and number; links of a node to itself count
    for nothing. A hub costs no more than its links: the least neighbour is found by an
    aggregate that starts before the shuffle. Each round ends in a written table.
    """
    high, low = F.greatest("u", "v"), F.least("u", "v")
    edges = stored(links.select(high.alias("u"), low.alias("v")).where("u > v").distinct(), "links")
    seen = None
    while True:
        edges = stored(small_star(large_star(edges)), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.toDF("node", "label").union(roots.withColumn("label", F.col("node")))
