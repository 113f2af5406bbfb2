"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.llm.common import join_counted, written


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("links"))
    return (join_counted(both, least, ["a"], "links", 2 * total).where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("links"))
    moved = (join_counted(edges, least, ["a"], "links", total).where("b <> m")
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """Node and least node of its component, for every node on a link other than that least one.

    `links` has the columns a and b (longs). Each round's edges are written to
    the shared folder, so a lost executor costs one round at most; the driver
    sees a count and a checksum per round only. The least neighbour of a hub is
    broadcast, so its links stay where they are.
    """
    edges = written(spark, links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(edges)
    while True:
        large = written(spark, _large_star(edges, state[0]), "links")
        edges = written(spark, _small_star(large, large.count()), "links")
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("least"))
