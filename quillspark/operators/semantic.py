"""Semantic search over quantised vectors: all rows by blocks, or routed through clusters with a horizon and a budget.

Queries are a table (query_id, vector) of unit vectors that an encoder gives; the few queries and the centroids are
broadcast, the corpus never is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.vectors import dot
from quillspark.operators.vector_ops import COLUMNS, TILE, Best, raw_matrix
from quillspark.sources.tables import stored

#: Places of best rows, and numbers of query vectors, that a task keeps at a time; more queries are searched in parts.
KEPT = 4_000_000
#: Characters that a query must have before anything is encoded.
LEAST = 3


def worth_encoding(query: str) -> bool:
    return len(query) >= LEAST


def score(query: Column, quantised: Column, largest: Column | float) -> Column:
    """Inner product with signed bytes, scaled back by largest / 127 and clipped to -1..1."""
    raw = dot(query, quantised) * (largest / 127.0 if isinstance(largest, Column) else F.lit(largest / 127.0))
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), raw))


def _top(scored: DataFrame, by: list[str], k: int, name: str) -> DataFrame:
    """Each group's k best rows; only k a task and group are shuffled."""
    return scored.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(F.round("cosine", 9)), "id"))).where(F.col(name) <= k)


def _vectors(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and which of them are null; those are zero."""
    null = column.is_null().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    if not null.all():
        out[~null] = raw_matrix(column.drop_null())
    return out, null


def _scan(asked: DataFrame, corpus: DataFrame, largest: float, k: int) -> DataFrame:
    """(query_id, cluster, visit, id, cosine): for each query and each cluster that it visits (query_id, cluster, visit, vector) the k best
    rows that a task has of a corpus (id, cluster, q). The queries are broadcast, the corpus streams past them in tiles."""
    spark = corpus.sparkSession
    n, width = asked.agg(F.count("*"), F.max(F.size("vector"))).first()
    parts = max(1, -(-n * max(k, width or 0) // KEPT))
    scale = largest / 127.0 if largest is not None else 0.0

    def part(i: int) -> DataFrame:
        table = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(parts)) == i).select("query_id", "cluster", "visit", "vector").orderBy("cluster").toArrow()
        names, clusters, visits = (table[c].to_numpy() for c in ("query_id", "cluster", "visit"))
        x, unknown = _vectors(table["vector"].combine_chunks(), width or 0)
        at = {c: slice(*np.searchsorted(clusters, [c, c + 1])) for c in np.unique(clusters).tolist()}
        shared = spark.sparkContext.broadcast((names, clusters, visits, x, unknown, at))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, clusters, visits, x, unknown, at = shared.value
            top = {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                y, null = _vectors(batch.column("q"), x.shape[1])
                ids, of = batch.column("id").to_numpy(), batch.column("cluster").to_numpy()
                for c in np.unique(of).tolist():
                    if c not in at:
                        continue
                    mine, seen = np.nonzero(of == c)[0], x[at[c]]
                    best = top.setdefault(c, Best(len(seen), k))
                    for i in range(0, len(seen), TILE):
                        for j in range(0, len(mine), COLUMNS):
                            some = mine[j : j + COLUMNS]
                            score = np.clip(seen[i : i + TILE] @ y[some].T * scale, -1, 1)
                            score[:, null[some]] = 1  # as SQL has it, where the least of 1 and null is 1
                            score[unknown[at[c]][i : i + TILE]] = 1
                            best.add(i, -score, ids[some])
            for c, best in top.items():
                r, found, score = best.found()
                r = r + at[c].start
                yield pa.record_batch([pa.array(names[r]), pa.array(clusters[r]), pa.array(visits[r]), pa.array(found), pa.array(-score)], names=["query_id", "cluster", "visit", "id", "cosine"])

        return corpus.select(F.col("id").cast("long").alias("id"), F.col("cluster").cast("long").alias("cluster"), "q").mapInArrow(run, "query_id long, cluster long, visit long, id long, cosine double")

    return reduce(DataFrame.union, map(part, range(parts)))


def _asked(queries: DataFrame, cluster: Column, visit: Column) -> DataFrame:
    return queries.select(F.col("query_id").cast("long").alias("query_id"), cluster.cast("long").alias("cluster"), visit.cast("long").alias("visit"), "vector").where("cluster is not null")


def search_all(queries: DataFrame, corpus: DataFrame, largest: float, k: int = 50) -> DataFrame:
    """(query_id, rank, id, cosine): each query's k best rows of the whole corpus (id, q), ties to the smaller id."""
    found = _scan(_asked(queries, F.lit(0), F.lit(0)), corpus.select("id", F.lit(0).alias("cluster"), "q"), largest, k)
    return _top(found.select("query_id", "id", "cosine"), ["query_id"], k, "rank")


def facade(query: str, encode, corpus: DataFrame, largest: float, k: int = 50) -> DataFrame:  # noqa: ANN001
    """(rank, id, cosine) of one query's text, encoded by ``encode``; nothing for a text that is too short."""
    spark = corpus.sparkSession
    if not worth_encoding(query):
        return spark.createDataFrame([], "rank int, id long, cosine double")
    asked = spark.createDataFrame([(0, [float(x) for x in encode(query)])], "query_id long, vector array<double>")
    return search_all(asked, corpus, largest, k).select("rank", "id", "cosine")


def route(queries: DataFrame, centroids: DataFrame) -> DataFrame:
    """(query_id, cluster, visit): clusters in the order of their centroids' similarity, from 1."""
    scored = centroids.crossJoin(F.broadcast(queries)).select("query_id", "cluster", dot(F.col("vector"), F.col("centroid")).alias("sim"))
    return scored.select("query_id", "cluster", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("sim", 9)), "cluster")).alias("visit"))


def routed(queries: DataFrame, corpus: DataFrame, centroids: DataFrame, edges: DataFrame, largest: float, *, k: int = 50, seeds: int | None = None, horizon: float = 0.8, budget: int | None = None) -> DataFrame:
    """(query_id, rank, id, cosine, source): routed search of a corpus (cluster, id, q) with neighbour lists (id, neighbour,
    distance, rank).

    Clusters are visited nearest first, up to the first whose best row is farther than ``horizon``, that one included, or until
    ``budget`` clusters are read. Each gives its ``seeds`` best rows; with their neighbours they are the candidates, scored
    again. Clusters that only neighbours lie in are read as long as the budget lasts, in the order in which seeds (by visit and
    rank) name them; a candidate of any other cluster has 1 less its distance to the first seed that names it (source
    ``knn-distance``). The rows of clusters beyond the budget are not scored.
    """
    seeds = seeds or max(20, -(-k // 4))
    order = route(queries, centroids)
    reach = order if budget is None else order.where(F.col("visit") <= budget)
    # the join on cluster reads the visited clusters only, if the corpus lies in folders by cluster
    near = corpus.join(F.broadcast(reach.select("cluster").distinct()), "cluster", "left_semi")
    found = _scan(_asked(reach.join(queries, "query_id"), F.col("cluster"), F.col("visit")), near, largest, seeds)
    hits = stored(_top(found, ["query_id", "cluster"], seeds, "place"), "hits")
    best = hits.groupBy("query_id", "visit").agg(F.max("cosine").alias("best"))
    stop = best.groupBy("query_id").agg(F.min(F.when(1 - F.col("best") > horizon, F.col("visit"))).alias("stop"), F.max("visit").alias("last"))
    swept = hits.join(F.broadcast(stop), "query_id").where(F.col("visit") <= F.coalesce("stop", "last"))
    named = swept.select("query_id", "visit", "place", F.col("id").alias("seed")).join(edges.select(F.col("id").alias("seed"), "neighbour", "distance", F.col("rank").alias("nth")), "seed")
    turn = F.struct("visit", "place", "nth")
    reached = named.groupBy("query_id", F.col("neighbour").alias("id")).agg(F.min(turn).alias("turn"), F.min_by("distance", turn).alias("distance"))
    reached = stored(reached.join(swept.select("query_id", "id"), ["query_id", "id"], "left_anti").join(corpus.select("id", "cluster", "q"), "id"), "reached")
    visited = swept.select("query_id", "cluster").distinct()
    fresh = reached.join(visited, ["query_id", "cluster"], "left_anti").groupBy("query_id", "cluster").agg(F.min("turn").alias("turn"))
    nth = fresh.withColumn("nth", F.row_number().over(Window.partitionBy("query_id").orderBy("turn", "cluster")))
    spent = visited.groupBy("query_id").agg(F.count("*").alias("spent"))
    closed = nth.join(spent, "query_id").where(F.lit(False) if budget is None else F.col("spent") + F.col("nth") > budget).select("query_id", "cluster", F.lit(True).alias("closed"))
    again = reached.join(closed, ["query_id", "cluster"], "left").join(F.broadcast(queries), "query_id")
    far = F.coalesce("closed", F.lit(False))
    again = again.select("query_id", "id", F.when(far, 1 - F.col("distance")).otherwise(score(F.col("vector"), F.col("q"), largest)).alias("cosine"), F.when(far, "knn-distance").otherwise("cosine").alias("source"))
    every = swept.select("query_id", "id", "cosine", F.lit("cosine").alias("source")).union(again)
    return _top(every, ["query_id"], k, "rank").select("query_id", "rank", "id", "cosine", "source")


def expand_keeping(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """(id): the seeds and all their neighbours."""
    return seeds.select("id").union(edges.join(seeds.select("id"), "id", "left_semi").select(F.col("neighbour").alias("id"))).distinct()
