"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platelake.session import cut_lineage, drop_scratch

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are tied to its smallest neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(
        F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").where(F.col("v") > F.col("m")).select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node that can be reached.

    Only nodes with an edge to another one have a row. Large-star and
    small-star steps alternate until every edge leads to a root; each round is
    a written table, so a lost executor repeats one round at most. Only counts
    and check sums of the edges come to the driver. Smallest neighbours are
    combined before the shuffle, and a hot node is joined, never gathered.
    """
    spark = edges.sparkSession
    start = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    current, path = cut_lineage(start.distinct(), "edges", with_path=True)
    seen = None
    for _ in range(MAX_ROUNDS):
        marks = current.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))
        ).first()
        if tuple(marks) == seen or marks[0] == 0:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = tuple(marks)
        step = _small_star(_large_star(current).distinct()).distinct()
        current, new_path = cut_lineage(step, "edges", with_path=True)
        drop_scratch(spark, path)
        path = new_path
    raise RuntimeError(f"edges still change after {MAX_ROUNDS} rounds")
