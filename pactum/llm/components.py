"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.llm.common import by_key, store


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(by_key(least), "u").where("v > u").select(
        F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(by_key(least), "u").where("v != m").select("v", "m")
    return moved.union(least.select("u", "m")).toDF("a", "b").distinct()


def _state(links: DataFrame):
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the smallest node names the component.

    Each round is written to the shared folder, so the plan of a round never
    holds the rounds before. The driver sees a count and a checksum per round.
    The result is exact; the number of rounds grows with the logarithm of the
    longest chain. Loops (a = b) and null ends carry no link and are ignored.
    """
    kept = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    at = store(kept.distinct(), "links")
    before = _state(at)
    while before[0]:
        at = store(_small_star(_large_star(at)), "links")
        now = _state(at)
        if now == before:
            break
        before = now
    return at.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        at.select("b", "b").distinct())
