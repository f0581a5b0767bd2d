"""Helpers shared by the operators: graph components, and the library's tables in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import discard
from ..sources.shared import written as materialize

__all__ = ["LOWER", "by_key", "connected_components", "discard", "materialize", "table"]

#: A byte table that lower-cases A-Z.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_key(groups: DataFrame, *keys: str) -> DataFrame:
    """``groups``, an aggregate by the long columns ``keys``, for a join on these with rows that one key may crowd.

    Adaptive execution splits a hot key only where both sides of a join come straight from a shuffle. An aggregate by
    the join's keys does not, as the join takes over its partitions; keys computed anew cost it one more shuffle, of
    a row a key.
    """
    return groups.withColumns({k: F.col(k).bitwiseXOR(F.lit(0).cast("long")) for k in keys})


def _min_neighbour(pairs: DataFrame) -> DataFrame:
    """(u, m): the smallest node among u and its neighbours; combined before the shuffle, so hubs do no harm."""
    return by_key(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "u")


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b, longs); component is its smallest node.

    Alternating large-star and small-star steps. Each is an aggregate and an equi-join on the node, whose
    skewed partitions (hubs) adaptive execution can split (see by_key); no adjacency list is ever built. The edges are
    written to the shared folder after each round. Raises if ``max_rounds`` do not suffice.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        star = both.where("v > u").join(_min_neighbour(both), "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        down = star.where("a <> b").distinct().select(F.col("a").alias("u"), F.col("b").alias("v"))
        joined = down.join(_min_neighbour(down), "u")
        old, edges = edges, materialize(joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(joined.select("u", "m")).where("a <> b").distinct())
        discard(old)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
