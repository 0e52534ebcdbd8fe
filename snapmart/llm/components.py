"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Every node hands its larger neighbours the smallest of itself and its neighbours; as many rows as edges."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = shared.cut(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
                     .select("a", F.least("a", "m").alias("m"), "n"))
    return shared.join_hot(both, low, "a", "n", 2 * n).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Every node hands itself and its smaller neighbours the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = shared.cut(down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")))
    moved = shared.join_hot(down, low, "a", "n", n).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def stars(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the component's smallest node, itself included) of every node in an edge (``a``, ``b``).

    Rounds go on until the edges stay the same; each half is written to the checkpoint
    folder, so a lost executor costs one of them.  Minima are combined before they are
    shuffled; a node with very many edges gets its minimum broadcast, and its edges stay
    spread over the tasks that hold them.
    """
    now, before = shared.cut(edges.where("a <> b").distinct()), None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == before:
            break
        before = tuple(seen)
        now = shared.cut(_small_star(shared.cut(_large_star(now, seen[0])), seen[0]))
    members = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members.unionByName(members.select(F.col("root").alias("node"), "root").distinct())
