"""Connected components of a link table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tracelens.llm.store import table


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to its smallest neighbour."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _written(spark: SparkSession, links: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The links as a written table, and a fingerprint of them that the write itself gathers."""
    seen = Observation()
    out = table(spark, links.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")), name)
    return out, (seen.get["n"], seen.get["x"])


def components(spark: SparkSession, edges: DataFrame, name: str) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: long); component is the smallest node.

    Union-find as alternating large-star and small-star rounds: each round is a
    few joins on the links, written to the shared folder, so a lost executor
    costs at most one round; a round that leaves the links as they are is the last.
    Rounds grow with the logarithm of the longest
    path.  A node with very many links is reduced map-side before it is
    shuffled.  Self-links and nulls are ignored; no links give no rows.
    """
    links, seen = _written(spark, edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), name)
    while True:
        links, now = _written(spark, _small_star(_large_star(links)), name)
        if now == seen:  # nothing moved: every link leads from a node to its root
            break
        seen = now
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
