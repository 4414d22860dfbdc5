"""Connected components by alternating large and small stars, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foreledger.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest of its neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min("b").alias("m"))
    return (
        both.join(smallest, "a")
        .where("b > a")
        .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them. Here b < a on every edge."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    rest = edges.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = smallest.select("a", F.col("m").alias("b"))
    return rest.unionByName(own).where("a <> b").distinct()


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """node and component, the smallest node it is connected to, for nodes on an edge a - b.

    A few small columns are shuffled in each round and the edges are written to
    the shared folder, so the lineage stays short; the driver sees a count and a
    checksum per round. Rounds grow with the logarithm of the longest chain.
    """
    canonical = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(canonical.where("a <> b").distinct(), "edges")
    before, after = None, _signature(now)
    while before != after:
        now = stored(_small_star(_large_star(now)), "edges")
        before, after = after, _signature(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
