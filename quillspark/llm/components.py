"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.store import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(store: Scratch, edges: DataFrame, longest: int = 60) -> DataFrame:
    """(node, component): the least node reachable, for every node of an edge list (a, b) of longs.

    Loops and nulls are ignored; repeated edges count once; no edges give no rows. Minima are aggregated before the
    shuffle and joined back, so a node with very many neighbours is never gathered in one task. Converged when a
    round changes nothing: edges then are stars.
    """
    now = store.save(edges.where("a != b").select("a", "b").distinct())
    before = None
    for _ in range(longest):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = mark
        after = store.save(_small_star(_large_star(now)))
        store.drop(now)
        now = after
    raise RuntimeError(f"components did not converge in {longest} rounds")
