"""Measures of clusterings and labels from contingency tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.sources.tables import stored


def size_metrics(rows: DataFrame, cluster: str) -> DataFrame:
    """(clusters, largest, spread, entropy): shares of the largest, deviation by mean, entropy by its maximum."""
    n = rows.groupBy(cluster).count()
    share = n.withColumn("p", F.col("count") / F.sum("count").over(Window.partitionBy()))
    return share.agg(F.count("*").alias("clusters"), F.max("p").alias("largest"), (F.stddev_pop("count") / F.avg("count")).alias("spread"), F.when(F.count("*") > 1, -F.sum(F.col("p") * F.log("p")) / F.log(F.count("*"))).otherwise(0.0).alias("entropy"))


def purity(rows: DataFrame, cluster: str, label: str) -> DataFrame:
    """(purity, entropy): clusters' largest label shares and label entropies, weighted by size."""
    table = rows.groupBy(cluster, label).count()
    by = Window.partitionBy(cluster)
    shares = table.withColumn("size", F.sum("count").over(by)).withColumn("p", F.col("count") / F.col("size"))
    each = shares.groupBy(cluster).agg(F.first("size").alias("size"), F.max("p").alias("top"), (-F.sum(F.col("p") * F.log("p"))).alias("h"))
    return each.agg((F.sum(F.col("size") * F.col("top")) / F.sum("size")).alias("purity"), (F.sum(F.col("size") * F.col("h")) / F.sum("size")).alias("entropy"))


def agreement(rows: DataFrame, a: str, b: str) -> DataFrame:
    """(nmi, homogeneity, completeness, v_measure, ari) of two labellings."""
    table = rows.groupBy(a, b).agg(F.count("*").alias("n"))
    t = table.withColumn("na", F.sum("n").over(Window.partitionBy(a))).withColumn("nb", F.sum("n").over(Window.partitionBy(b)))
    total = table.agg(F.sum("n").alias("total"))
    t = t.crossJoin(F.broadcast(total))
    p = lambda c: F.col(c) / F.col("total")
    pairs = lambda c: F.col(c) * (F.col(c) - 1) / 2
    mutual = t.agg(F.sum(p("n") * F.log(F.col("n") * F.col("total") / (F.col("na") * F.col("nb")))).alias("mi"), F.sum(pairs("n")).alias("both"), F.first("total").alias("total"))
    one = lambda c, k: rows.groupBy(c).agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).agg((-F.sum(p("n") * F.log(p("n")))).alias(f"h{k}"), F.sum(pairs("n")).alias(f"pairs{k}"))
    m = mutual.crossJoin(one(a, "a")).crossJoin(one(b, "b"))
    share = lambda x, h: F.when(F.col(h) == 0, 1.0).otherwise(F.col(x) / F.col(h))
    m = m.withColumn("homogeneity", share("mi", "ha")).withColumn("completeness", share("mi", "hb"))
    expected = F.col("pairsa") * F.col("pairsb") / (F.col("total") * (F.col("total") - 1) / 2)
    top = (F.col("pairsa") + F.col("pairsb")) / 2 - expected
    nmi = F.when(F.col("ha") + F.col("hb") == 0, 1.0).otherwise(2 * F.col("mi") / (F.col("ha") + F.col("hb")))
    v = F.when(F.col("homogeneity") + F.col("completeness") == 0, 0.0).otherwise(2 * F.col("homogeneity") * F.col("completeness") / (F.col("homogeneity") + F.col("completeness")))
    return m.select(nmi.alias("nmi"), "homogeneity", "completeness", v.alias("v_measure"), F.when(top == 0, 1.0).otherwise((F.col("both") - expected) / top).alias("ari"))


def min_max(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Columns scaled to 0..1; a constant column becomes 0."""
    ends = rows.agg(*(f(c).alias(f"_{k}_{c}") for c in columns for k, f in (("low", F.min), ("high", F.max))))
    rows = rows.crossJoin(F.broadcast(ends))  # a single row
    for c in columns:
        low, high = F.col(f"_low_{c}"), F.col(f"_high_{c}")
        rows = rows.withColumn(c, F.when(high == low, 0.0).otherwise((F.col(c) - low) / (high - low)))
    return rows.drop(*ends.columns)


def ctfidf(counts: DataFrame) -> DataFrame:
    """(cluster, term, score): count / cluster total x ln(1 + clusters / clusters with the term)."""
    counts = stored(counts.groupBy("cluster", "term").agg(F.sum("n").alias("n")), "counts")
    total = counts.groupBy("cluster").agg(F.sum("n").alias("total"))
    clusters = total.agg(F.count("*").alias("clusters"))
    spread = counts.groupBy("term").agg(F.count("*").alias("df"))
    joined = counts.join(total, "cluster").join(spread, "term").crossJoin(F.broadcast(clusters))
    return joined.select("cluster", "term", (F.col("n") / F.col("total") * F.log(1 + F.col("clusters") / F.col("df"))).alias("score"))


def _log_factorials(x: np.ndarray) -> np.ndarray:
    """ln x! by Stirling's series, shifted so that small numbers are exact to 1e-14."""
    x = np.asarray(x, np.float64) + 1.0
    shift = np.zeros_like(x)
    for _ in range(12):
        small = x < 12
        shift -= np.where(small, np.log(x), 0.0)
        x = np.where(small, x + 1, x)
    return shift + (x - 0.5) * np.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)


def expected_mutual_information(a: int, b: int, n: int) -> float:
    """What a cluster of a and one of b rows of n add to the mutual information in the mean, over all permutations; the sum runs
    over 40 deviations around the mean overlap, beyond which nothing of double precision is left."""
    low, high = max(1, a + b - n), min(a, b)
    mean = a * b / n
    reach = 40 * np.sqrt(mean * (1 - a / n) * (1 - b / n) + 1) + 40
    k = np.arange(max(low, int(mean - reach)), min(high, int(mean + reach)) + 1, dtype=np.float64)
    if not len(k):
        return 0.0
    f = _log_factorials
    chance = f(a) + f(b) + f(n - a) + f(n - b) - f(n) - f(k) - f(a - k) - f(b - k) - f(n - a - b + k)
    return float((k / n * np.log(n * k / (a * b)) * np.exp(chance)).sum())


def adjusted_mutual_information(rows: DataFrame, a: str, b: str) -> DataFrame:
    """(ami): mutual information of two labellings less what chance gives, by the mean of their entropies; 1 if both have one
    value or one a row. Pairs of clusters are scored apart, so only sums come together."""
    table = rows.groupBy(a, b).agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*").alias("total"))
    side = lambda c, name: rows.groupBy(c).agg(F.count("*").alias(name))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [x * expected_mutual_information(i, j, t) for i, j, t, x in zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "total", "times")))]
            yield pa.record_batch([pa.array(got, pa.float64())], names=["emi"])

    # clusters of one size expect the same
    left, right = (side(c, n).groupBy(n).agg(F.count("*").alias(f"c{n}")) for c, n in ((a, "na"), (b, "nb")))
    pairs = left.crossJoin(F.broadcast(right)).crossJoin(F.broadcast(total)).select("na", "nb", "total", (F.col("cna") * F.col("cnb")).alias("times"))
    expected = pairs.mapInArrow(score, "emi double").agg(F.sum("emi").alias("emi"))
    entropy = lambda c, n: side(c, n).crossJoin(F.broadcast(total)).agg((-F.sum(F.col(n) / F.col("total") * F.log(F.col(n) / F.col("total")))).alias(f"h{n}"), F.count("*").alias(f"k{n}"))
    joined = table.join(side(a, "na"), a).join(side(b, "nb"), b).crossJoin(F.broadcast(total))
    mutual = joined.agg(F.sum(F.col("n") / F.col("total") * F.log(F.col("n") * F.col("total") / (F.col("na") * F.col("nb")))).alias("mi"), F.first("total").alias("total"))
    m = mutual.crossJoin(expected).crossJoin(entropy(a, "na")).crossJoin(entropy(b, "nb"))
    trivial = ((F.col("kna") == 1) & (F.col("knb") == 1)) | ((F.col("kna") == F.col("total")) & (F.col("knb") == F.col("total")))
    return m.select(F.when(trivial, 1.0).otherwise((F.col("mi") - F.col("emi")) / ((F.col("hna") + F.col("hnb")) / 2 - F.col("emi"))).alias("ami"))


def fragmentation(rows: DataFrame, cluster: str, reference: str) -> DataFrame:
    """(active, entropy): over how many clusters a reference label spreads, and its entropy over clusters by the largest one
    possible, both weighted by the labels' sizes."""
    table = rows.groupBy(reference, cluster).agg(F.count("*").alias("n"))
    by = Window.partitionBy(reference)
    each = table.withColumn("size", F.sum("n").over(by)).withColumn("p", F.col("n") / F.col("size")).groupBy(reference).agg(F.first("size").alias("size"), F.count("*").alias("active"), (-F.sum(F.col("p") * F.log("p"))).alias("h"))
    clusters = rows.agg(F.count_distinct(cluster).alias("clusters"))
    share = F.when((F.col("active") > 1) & (F.col("clusters") > 1), F.col("h") / F.log("clusters")).otherwise(0.0)
    return each.crossJoin(F.broadcast(clusters)).agg((F.sum(F.col("active") * F.col("size")) / F.sum("size")).alias("active"), (F.sum(share * F.col("size")) / F.sum("size")).alias("entropy"))


def recall_at(found: DataFrame, ideal: DataFrame, k: int) -> DataFrame:
    """(recall): the mean share of each row's k ideal neighbours (id, neighbour, rank) that are among its k found ones."""
    a, b = (d.where(F.col("rank") <= k).select("id", "neighbour") for d in (found, ideal))
    hits = b.join(a.withColumn("hit", F.lit(1)), ["id", "neighbour"], "left").groupBy("id").agg(F.sum(F.coalesce("hit", F.lit(0))).alias("hits"))
    return hits.agg(F.avg(F.col("hits") / k).alias("recall"))


def centroid_agreement(scored: DataFrame, truth: DataFrame) -> DataFrame:
    """(top1, top3): how often a row's own cluster is its nearest centroid, or one of the nearest three. scored: (id, cluster,
    similarity); truth: (id, label)."""
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "cluster"))
    near = scored.withColumn("place", place).where("place <= 3").join(truth, "id").where(F.col("cluster") == F.col("label")).select("id", "place")
    return truth.select("id").join(near, "id", "left").agg(F.avg(F.coalesce((F.col("place") == 1).cast("int"), F.lit(0))).alias("top1"), F.avg(F.col("place").isNotNull().cast("int")).alias("top3"))


def overlap_entropy(rows: DataFrame, probabilities: str) -> DataFrame:
    """Rows with the entropy of their cluster probabilities by the largest one possible; 0 for one cluster."""
    h = F.aggregate(probabilities, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log(p)).otherwise(0.0))
    return rows.withColumn("entropy", F.when(F.size(probabilities) > 1, h / F.log(F.size(probabilities))).otherwise(0.0))
