"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a minimum for each node (combined before the shuffle) and a join, so no task holds a node's neighbours.
The labels converge in a number of rounds that grows with the logarithm of the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the least of itself and all neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node ties itself and its smaller neighbours to the least of them. Edges point from the larger to the smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected(pairs: DataFrame) -> DataFrame:
    """(id, component) of every id in pairs (a, b); the component is the least id that is reachable. Loops and repeats do no harm."""
    edges = common.stored(pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        fresh = common.stored(_small_star(_large_star(edges)), "star")
        common.drop(edges)
        edges = fresh
        said = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(said) == before:
            break
        before = tuple(said)
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
