"""Connected components by alternating large-star and small-star steps.

Edges stay distributed; every step is a minimum per node (combined before the
shuffle) joined back to the edges, so a node with very many neighbours is split
like any skewed join. Each round ends at a written table. The loop stops when the
edges are stars, each around the least node of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import materialise


def _settled(edges: DataFrame) -> bool:
    """Whether edges (u > v) are stars: each u has one v, and no v is a u."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("low")).unionAll(
        edges.select("v", F.lit(0), F.lit(1)))
    per_node = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("low").alias("low"))
    return per_node.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("low") > 0))).count() == 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(low, F.col("u") == F.col("k")).select(
        F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low.withColumnRenamed("u", "k"), F.col("u") == F.col("k")).select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges``: u, v of one comparable type, u != v. Returns node, label for every
    node of an edge other than its component's least node, the label; a node
    without a row is its own label. No edges: no rows. Rounds grow with the
    logarithm of the longest path; passing ``max_rounds`` is an error."""
    now = materialise(edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    rounds = 0
    while not _settled(now):
        if rounds == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        now = materialise(_small_star(_large_star(now)), "cc")
        rounds += 1
    return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
