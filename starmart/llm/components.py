"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each node of an edge with the smallest node that it can reach.

    Each round points a node's neighbours to the smallest node of its neighbourhood, first the larger neighbours, then the
    others; this keeps components as they are and ends in stars after a number of rounds about the logarithm of the longest
    path. Minima are combined before the shuffle, no neighbourhood is gathered, and every round starts from a written table.
    """
    now = staged(_tidy(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    mark = _mark(now)
    while True:
        now = staged(_small(_large(now)), "edges")
        after = _mark(now)
        if after == mark:
            break
        mark = after
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(leaves.select(F.col("component").alias("node"), "component").distinct())


def _tidy(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    """What tells two rounds' edges apart."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first())


def _large(edges: DataFrame) -> DataFrame:
    """Each neighbour larger than a node is pointed to the node's smallest neighbour, itself included."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _tidy(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small(edges: DataFrame) -> DataFrame:
    """Each node, and its neighbours not larger, are pointed to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _tidy(moved.unionByName(least.select("u", F.col("m").alias("v"))))
