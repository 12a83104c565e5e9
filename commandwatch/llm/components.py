"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spark_io import checkpointed


def _minima(edges: DataFrame) -> DataFrame:
    """The least neighbour of each node. It is written, so that a node with very many edges
    meets its row in a join of two plain exchanges, which Spark can split."""
    return checkpointed(edges.groupBy("u").agg(F.min("v").alias("least")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    met = both.join(_minima(both), "u").where("v > u")
    return met.select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    minima = _minima(edges)
    met = edges.join(minima, "u").where("v > least")
    tied = met.select(F.col("v").alias("u"), F.col("least").alias("v"))
    return tied.unionByName(minima.withColumnRenamed("least", "v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node of links (a, b); component is the least id in reach.

    Nulls and links of a node with itself are left out; an empty table gives no rows. Each
    round's edges are written; the rounds end when they stay the same, which takes some log n
    rounds, and two for stars.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = checkpointed(edges), None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
        edges = checkpointed(_small_star(checkpointed(_large_star(edges))))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
