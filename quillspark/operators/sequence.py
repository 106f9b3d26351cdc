"""Measures of sequences of vectors, and a greedy order of small groups."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.vectors import cosine
from quillspark.operators.vector_ops import BLOCK, TILE, matrix, unit_rows


def near_pairs(rows: DataFrame, position: str, vector: str, width: int) -> DataFrame:
    """(i, j, similarity) for positions 0 < j - i <= width: each row is dealt to the places that it reaches, so the
    join is on equal keys and a row travels ``width`` times, however long the sequence is."""
    left = rows.select(F.col(position).alias("i"), F.col(vector).alias("a")).withColumn("j", F.explode(F.sequence(F.col("i") + 1, F.col("i") + width)))
    right = rows.select(F.col(position).alias("j"), F.col(vector).alias("b"))
    return left.join(right, "j").select("i", "j", cosine(F.col("a"), F.col("b")).alias("similarity"))


def window_distances(rows: DataFrame, position: str, vector: str, width: int) -> DataFrame:
    """(adjacent_mean, adjacent_median, window_mean, window_median) of cosine distances."""
    d = near_pairs(rows, position, vector, width).select((F.col("j") - F.col("i")).alias("gap"), (1 - F.col("similarity")).alias("d"))
    next_ = F.when(F.col("gap") == 1, F.col("d"))
    return d.agg(F.avg(next_).alias("adjacent_mean"), F.median(next_).alias("adjacent_median"), F.avg("d").alias("window_mean"), F.median("d").alias("window_median"))


def neighbour_means(rows: DataFrame, position: str, vector: str, k: int = 5) -> DataFrame:
    """(position, mean): mean similarity to the k nearest positions, ties to the lower one; positions are gapless."""
    pairs = near_pairs(rows, position, vector, k)
    both = pairs.select(F.col("i").alias("p"), F.col("j").alias("q"), "similarity").union(pairs.select("j", "i", "similarity"))
    place = F.row_number().over(Window.partitionBy("p").orderBy(F.abs(F.col("q") - F.col("p")), "q"))
    near = both.withColumn("_n", place).where(F.col("_n") <= k)
    return near.groupBy(F.col("p").alias("position")).agg(F.avg("similarity").alias("mean"))


def tail(means: DataFrame) -> DataFrame:
    """(mean, median, p10, below_06, below_05) of neighbour means."""
    m = F.col("mean")
    return means.agg(F.avg(m).alias("mean"), F.median(m).alias("median"), F.percentile(m, 0.1).alias("p10"), F.count_if(m < 0.6).alias("below_06"), F.count_if(m < 0.5).alias("below_05"))


def greedy_paths(rows: DataFrame, group: str, key: str, vector: str, most: int = 20_000) -> DataFrame:
    """(group, id, place): in every group a path from the row nearest to the centroid, each time to the most similar
    row left; ties go to the smaller id. The walk is sequential, so a group is one task; its size is checked and a
    group of more than ``most`` rows is an error. Rows without key or vector take no part."""
    usable = rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull())
    if not usable.groupBy(group).count().where(F.col("count") > most).isEmpty():
        raise ValueError(f"a group has more than {most} rows; part it first")
    kind = usable.schema[group].dataType.simpleString()

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable").reset_index(drop=True)
        x = unit_rows(np.array(pdf["v"].tolist(), np.float64))
        free = np.ones(len(x), dtype=bool)
        gain, path = x @ x.mean(0), []
        for _ in range(len(x)):
            now = int(np.where(free, np.round(gain, 12), -np.inf).argmax())
            free[now] = False
            path.append(now)
            gain = x @ x[now]
        return pd.DataFrame({"group": pdf["group"].to_numpy()[path], "id": pdf["id"].to_numpy()[path], "place": np.arange(len(path))})

    return usable.select(F.col(group).alias("group"), F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).groupBy("group").applyInPandas(walk, f"`group` {kind}, id long, place long")


def window_score(rows: DataFrame, position: str, vector: str, width: int = 5) -> DataFrame:
    """(score): similarities of positions up to ``width`` apart, each by its offset; 0 for fewer than two rows."""
    pairs = near_pairs(rows, position, vector, width)
    return pairs.agg(F.coalesce(F.sum(F.col("similarity") / (F.col("j") - F.col("i"))), F.lit(0.0)).alias("score"))


def offset_weights(rows: DataFrame, position: str, vector: str, block: int = BLOCK) -> DataFrame:
    """(offset, weight): the positive cosine similarities of all pairs of positions, added up by how far they are apart.

    Positions are dealt into blocks; a pair of blocks gives a sum for each offset between them, so no similarity leaves a task.
    """
    placed = rows.select(F.col(position).cast("long").alias("p"), F.col(vector).alias("v"))
    most = placed.agg(F.max("p")).first()[0]
    n = 1 + (most or 0) // block
    b = F.floor(F.col("p") / block).cast("int")
    left = placed.select("p", "v", b.alias("i"), F.explode(F.sequence(b, F.lit(n - 1))).alias("j"))
    right = placed.select("p", "v", F.explode(F.sequence(F.lit(0), b)).alias("i"), b.alias("j"))

    def sums(a: pa.Table, b: pa.Table) -> pa.Table:
        total = np.zeros(2 * block + 1)
        low = 0
        if a.num_rows and b.num_rows:
            p, q, x, y = a["p"].to_numpy(), b["p"].to_numpy(), matrix(a["v"]), matrix(b["v"])
            low = max(1, int(q.min() - p.max()))
            for at in range(0, len(x), TILE):
                near = np.maximum(x[at : at + TILE] @ y.T, 0)
                gap = q[None] - p[at : at + TILE, None]
                total += np.bincount((gap - low)[gap > 0], weights=near[gap > 0], minlength=len(total))
        some = np.flatnonzero(total)
        return pa.table({"offset": some + low, "weight": total[some]})

    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(sums, "offset long, weight double").groupBy("offset").agg(F.sum("weight").alias("weight"))


def edge_mass(rows: DataFrame, position: str, vector: str, width: int = 5) -> DataFrame:
    """(weight, adjacent, window, distance, squared, half, most): the similarity of all pairs, the shares of neighbours and of pairs
    up to ``width`` apart, the mean offset and its square, and the offsets that hold 50 % and 80 % of it."""
    from quillspark.sources.tables import stored

    w = stored(offset_weights(rows, position, vector), "offsets")
    total = w.agg(F.sum("weight").alias("total"))
    share = lambda c: F.sum(F.when(c, F.col("weight")).otherwise(0.0)) / F.sum("weight")
    means = w.agg(F.sum("weight").alias("weight"), share(F.col("offset") == 1).alias("adjacent"), share(F.col("offset") <= width).alias("window"), (F.sum(F.col("weight") * F.col("offset")) / F.sum("weight")).alias("distance"), (F.sum(F.col("weight") * F.col("offset") * F.col("offset")) / F.sum("weight")).alias("squared"))
    # a row an offset, not a pair
    so_far = w.withColumn("so_far", F.sum("weight").over(Window.orderBy("offset"))).crossJoin(F.broadcast(total))
    reach = lambda part: F.min(F.when(F.col("so_far") >= part * F.col("total"), F.col("offset")))
    return means.crossJoin(so_far.agg(reach(0.5).alias("half"), reach(0.8).alias("most")))


def community_measures(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(communities, coverage, density, conductance): of an undirected graph (u, v, w) and labels (id, label): the share of
    edges inside communities, and the means by size of the weight inside by possible edges and of the weight that leaves by the
    lesser weight of both sides."""
    a, b = (labels.select(F.col("id").alias(x), F.col("label").alias(f"l{x}")) for x in "uv")
    both = edges.join(a, "u").join(b, "v")
    inside = both.where("lu = lv").groupBy(F.col("lu").alias("label")).agg(F.sum("w").alias("inside"))
    ends = both.select(F.col("lu").alias("label"), "w", (F.col("lu") != F.col("lv")).alias("cut")).union(both.select("lv", "w", F.col("lu") != F.col("lv")))
    volume = ends.groupBy("label").agg(F.sum("w").alias("volume"), F.sum(F.when(F.col("cut"), F.col("w")).otherwise(0.0)).alias("cut"))
    whole = both.agg((2 * F.sum("w")).alias("all"), (F.count_if(F.col("lu") == F.col("lv")) / F.count("*")).alias("coverage"))
    each = labels.groupBy("label").agg(F.count("*").alias("n")).join(inside, "label", "left").join(volume, "label", "left").crossJoin(F.broadcast(whole))
    less = F.least(F.col("volume"), F.greatest(F.col("all") - F.col("volume"), F.lit(0.0)))
    density = F.when(F.col("n") > 1, F.coalesce("inside", F.lit(0.0)) / (F.col("n") * (F.col("n") - 1) / 2)).otherwise(0.0)
    conductance = F.when(less > 1e-12, F.col("cut") / less).otherwise(0.0)
    mean = lambda c: F.sum(F.col("n") * F.coalesce(c, F.lit(0.0))) / F.sum("n")
    return each.agg(F.count("*").alias("communities"), F.first("coverage").alias("coverage"), mean(density).alias("density"), mean(conductance).alias("conductance"))
