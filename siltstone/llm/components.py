"""Connected components of a graph in a DataFrame, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def _large(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest of itself and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the smallest of them. edges: u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for the nodes of edges (a, b); each round is written to the shared folder.

    Rounds grow as the logarithm of the nodes. Minima are combined on the map side; a node with very many neighbours is
    split by Spark's skew join. Self links count, nulls do not; without edges there are no rows.
    """
    now = edges.where("a is not null and b is not null").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    alone = now.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("component"))
    now, before = stored(now.where("u <> v"), "edges"), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        now = stored(_small(_large(now).where("u <> v").distinct()).where("u <> v").distinct(), "edges")
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.union(found.select(F.col("component").alias("node"), "component")).union(alone).groupBy("node").agg(F.min("component").alias("component"))
