"""Connected components by alternating star contraction, on distributed edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(a, b)``; the component is its smallest node.

    Large stars hang all larger neighbours of a node on its smallest neighbour, small stars the
    smaller ones; both keep the components and shorten all paths, in a number of rounds that grows
    with the logarithm of the longest path. Each round is a written table.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    pairs = edges.select(larger.alias("u"), smaller.alias("v")).where("u <> v").distinct()
    current = materialise(pairs, "edges")
    mark = _mark(current)
    while mark[0]:
        contracted = materialise(_small_star(_large_star(current)), "edges")
        new = _mark(contracted)
        current, done, mark = contracted, new == mark, new
        if done:
            break
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(centres)


def _mark(edges: DataFrame) -> tuple:
    """Count and checksum; equal when a round changed nothing."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # Written, so that both sides of the join are plain shuffles and Spark can split the centre of a large star.
    least = materialise(least, "least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = materialise(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    rest = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
