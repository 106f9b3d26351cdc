"""Connected components of neighbour graphs, and the bridges that join them into one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators.relational import dense_ids
from quillspark.operators.vector_ops import BLOCK, TILE, matrix
from quillspark.sources.tables import stored


def components(edges: DataFrame, ids: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component): the least id reachable over edges (u, v), for every id; an id without edges is its own.

    Every round a node takes the least label among its neighbours' and its own, and then its label's label, so chains shrink by
    halves. Minima are aggregated before the shuffle; each round is a stored table.
    """
    both = stored(edges.select("u", "v").union(edges.select("v", "u")).where("u <> v").distinct(), "edges")
    now = stored(ids.select("id", F.col("id").alias("component")).distinct(), "labels")
    for _ in range(rounds):
        least = both.join(now.select(F.col("id").alias("v"), "component"), "v").groupBy(F.col("u").alias("id")).agg(F.min("component").alias("m"))
        lower = stored(now.join(least, "id", "left").select("id", F.least("component", "m").alias("next"), "component"), "lower")
        jump = lower.select(F.col("id").alias("next"), F.col("next").alias("jumped"))
        after = stored(lower.join(jump, "next", "left").select("id", F.least("next", "jumped").alias("component"), (F.col("component") != F.least("next", "jumped")).alias("moved")), "labels")
        if after.where("moved").isEmpty():
            return after.drop("moved")
        now = after.drop("moved")
    raise RuntimeError(f"components did not converge in {rounds} rounds")


def bridges(labels: DataFrame, vectors: DataFrame, key: str, vector: str, block: int = BLOCK) -> DataFrame:
    """(u, v, w): for every two components that follow each other by their least ids, the most similar pair of rows of both, ties
    to the smaller ids; w is their cosine similarity, 1e-6 at least. Components meet in blocks, and a pair of blocks gives one row."""
    order = dense_ids(labels.select("component").distinct(), ["component"], "place")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).join(labels, "id").join(order, "component").select("id", "v", "place")
    sizes = rows.groupBy("place").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    theirs = sizes.select((F.col("place") - 1).alias("place"), F.col("blocks").alias("others"))
    dealt = sizes.join(theirs, "place")  # the last component has none after it
    part = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.join(dealt, "place").select("place", "id", "v", part(F.col("blocks")).alias("i"), every("others").alias("j"))
    right = rows.select((F.col("place") - 1).alias("place"), F.col("id").alias("id"), F.col("v").alias("v")).join(dealt, "place").select("place", "id", "v", every("blocks").alias("i"), part(F.col("others")).alias("j"))

    def best(a: pa.Table, b: pa.Table) -> pa.Table:
        found = (-np.inf, 0, 0)
        if a.num_rows and b.num_rows:
            a, b = a.sort_by("id"), b.sort_by("id")
            ids, others, x, y = a["id"].to_numpy(), b["id"].to_numpy(), matrix(a["v"]), matrix(b["v"])
            for at in range(0, len(x), TILE):
                near = np.round(np.maximum(x[at : at + TILE] @ y.T, 0), 9)
                i, j = np.unravel_index(int(near.argmax()), near.shape)
                found = max(found, (float(near[i, j]), -int(ids[at + i]), -int(others[j])))
        some = np.isfinite(found[0])
        place = a["place"] if a.num_rows else b["place"]
        return pa.table({"place": pa.array([place[0].as_py()] if some else [], pa.int64()), "w": pa.array([found[0]] if some else [], pa.float64()), "u": pa.array([-found[1]] if some else [], pa.int64()), "v": pa.array([-found[2]] if some else [], pa.int64())})

    near = left.groupBy("place", "i", "j").cogroup(right.groupBy("place", "i", "j")).applyInArrow(best, "place long, w double, u long, v long")
    top = near.groupBy("place").agg(F.max(F.struct("w", (-F.col("u")).alias("u"), (-F.col("v")).alias("v"))).alias("b"))
    return top.select((-F.col("b.u")).alias("u"), (-F.col("b.v")).alias("v"), F.greatest(F.lit(1e-6), "b.w").alias("w"))


def connected(edges: DataFrame, vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(u, v, w): the graph and its bridges."""
    ids = vectors.select(F.col(key).cast("long").alias("id"))
    return edges.select("u", "v", "w").union(bridges(components(edges, ids), vectors, key, vector))
