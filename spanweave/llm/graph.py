"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.shared import written


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.countDistinct("u")).first())


def components(edges: DataFrame) -> DataFrame:
    """edges: (a, b) long -> (node, label): the smallest node reachable, for every node that has an edge.

    Alternates large-star and small-star steps: every node hands its larger, then its smaller neighbours to its smallest
    one, until only stars are left: a large-star step changes nothing and no node has two smaller neighbours.  That takes
    a number of rounds like the logarithm of the number of nodes.  Minima are written before they are joined, so that
    Spark can split nodes with very many neighbours.
    """
    links = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
        large = written(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        state = _state(large)
        if state[0] == state[2] and state == _state(links):
            roots = links.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            return links.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        ends = F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")
        small = large.join(least, "u").select(ends).select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
        links = written(small.filter("u > v").distinct(), "links")
