"""Clusterings by MLlib and their measures; distances are Euclidean."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.sources.tables import stored


def _long(vectors: DataFrame, cluster: str, vector: str) -> DataFrame:
    return vectors.where(F.col(cluster).isNotNull()).select(F.col(cluster).alias("c"), F.posexplode(vector).alias("pos", "x")).withColumn("x", F.col("x").cast("double"))


def _centres(vectors: DataFrame, cluster: str, vector: str) -> DataFrame:
    """(c, m): component means."""
    means = _long(vectors, cluster, vector).groupBy("c", "pos").agg(F.avg("x").alias("x"))
    return means.groupBy("c").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("m"))


def _distance(a: str, b: str):
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, v: s + v))


def _own(vectors: DataFrame, cluster: str, vector: str, most: int) -> tuple[DataFrame, DataFrame, int]:
    """(c, d) of every row to its centroid, the centroids, broadcast up to ``most`` of them, and their number."""
    centres = stored(_centres(vectors, cluster, vector), "centres")
    many = centres.count()
    rows = vectors.select(F.col(cluster).alias("c"), F.col(vector).alias("v")).join(F.broadcast(centres) if many <= most else centres, "c")
    return rows.select("c", _distance("v", "m").alias("d")), centres, many


def _between(centres: DataFrame, many: int, most: int) -> DataFrame:
    """(a, b, gap) of all pairs of centroids, dealt into blocks of about ``most``, each of which meets each other one once."""
    n = max(1, -(-many // most))
    block = F.pmod(F.hash("c"), F.lit(n))
    every = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = centres.select(F.col("c").alias("a"), F.col("m").alias("ma"), block.alias("i"), every.alias("j"))
    b = centres.select(F.col("c").alias("b"), F.col("m").alias("mb"), every.alias("i"), block.alias("j"))
    return a.join(b, ["i", "j"]).where("a < b").select("a", "b", _distance("ma", "mb").alias("gap"))


def separation(vectors: DataFrame, cluster: str, vector: str, most: int = 2_000) -> DataFrame:
    """(intra, inter, ratio): mean distance of rows to their centroid, mean distance of two centroids, and inter by
    intra (by 1 if intra is 0). One cluster has an inter of 0. Up to ``most`` centroids are broadcast."""
    own, centres, many = _own(vectors, cluster, vector, most)
    both = own.agg(F.avg("d").alias("intra")).crossJoin(_between(centres, many, most).agg(F.coalesce(F.avg("gap"), F.lit(0.0)).alias("inter")))
    return both.select("intra", "inter", (F.col("inter") / F.when(F.col("intra") > 0, F.col("intra")).otherwise(1.0)).alias("ratio"))


def scatter(vectors: DataFrame, cluster: str, vector: str, most: int = 2_000) -> DataFrame:
    """(calinski_harabasz, davies_bouldin); null where there are fewer than two clusters."""
    own, centres, many = _own(vectors, cluster, vector, most)
    spread = own.groupBy("c").agg(F.avg("d").alias("s"), F.sum(F.col("d") * F.col("d")).alias("inside"), F.count("*").alias("n"))
    whole = _long(vectors, cluster, vector).groupBy("pos").agg(F.avg("x").alias("x")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("all"))
    apart = centres.join(spread, "c").crossJoin(F.broadcast(whole)).select("n", "inside", (F.col("n") * F.pow(_distance("m", "all"), 2)).alias("outside"))
    k, n = F.count("*"), F.sum("n")
    ch = apart.agg(F.when(k > 1, (F.sum("outside") / (k - 1)) / F.nullif(F.sum("inside") / (n - k), F.lit(0.0))).alias("calinski_harabasz"))
    size = lambda x: spread.select(F.col("c").alias(x), F.col("s").alias(f"s{x}"))
    likeness = _between(centres, many, most).join(size("a"), "a").join(size("b"), "b").select("a", "b", ((F.col("sa") + F.col("sb")) / F.nullif("gap", F.lit(0.0))).alias("r"))
    worst = likeness.select(F.col("a").alias("c"), "r").union(likeness.select("b", "r")).groupBy("c").agg(F.max("r").alias("r"))
    return ch.crossJoin(worst.agg(F.avg("r").alias("davies_bouldin")))


def fit(vectors: DataFrame, key: str, vector: str, k: int, method: str = "kmeans", components: int | None = None, seed: int = 1) -> DataFrame:
    """(id, cluster) by MLlib over unit vectors, after a PCA to ``components`` if that is given.

    method: kmeans, bisecting or gmm. Rows without key or vector take no part.
    """
    from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
    from pyspark.ml.feature import PCA, Normalizer
    from pyspark.ml.functions import array_to_vector

    kinds = {"kmeans": KMeans, "bisecting": BisectingKMeans, "gmm": GaussianMixture}
    if method not in kinds:
        raise ValueError(f"method must be one of {sorted(kinds)}")
    usable = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull())
    rows = usable.select(F.col(key).cast("long").alias("id"), array_to_vector(F.col(vector).cast("array<double>")).alias("raw"))
    rows, column = Normalizer(inputCol="raw", outputCol="unit").transform(rows), "unit"
    if components:
        rows, column = PCA(k=components, inputCol="unit", outputCol="flat").fit(rows).transform(rows), "flat"
    model = kinds[method](k=k, seed=seed, featuresCol=column, predictionCol="cluster").fit(rows)
    return model.transform(rows).select("id", "cluster")
