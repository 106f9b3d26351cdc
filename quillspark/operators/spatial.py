"""Selections in the plane and levels of detail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators.relational import dense_ids
from quillspark.sources.tables import stored


def in_box(x: Column, y: Column, box: tuple[float, float, float, float]) -> Column:
    """Closed bounds: left, bottom, right, top."""
    return x.between(box[0], box[2]) & y.between(box[1], box[3])


def in_polygon(x: Column, y: Column, corners: list[tuple[float, float]]) -> Column:
    """Even-odd rule behind a bounding box; fewer than three corners hold nothing."""
    if len(corners) < 3:
        return F.lit(False)
    crossings = F.lit(0)
    for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1]):
        if ay != by:
            across = (F.lit(float(ay)) > y) != (F.lit(float(by)) > y)
            crossings = crossings + F.when(across & (x < (y - ay) * ((bx - ax) / (by - ay)) + ax), 1).otherwise(0)
    xs, ys = zip(*corners)
    return in_box(x, y, (min(xs), min(ys), max(xs), max(ys))) & (crossings % 2 == 1)


def cells(points: DataFrame, x: str, y: str, resolution: int, span: tuple[float, float, float]) -> Column:
    """A square grid's cell; span: least x, least y and the longer side."""
    place = lambda c, low: F.least(F.floor((F.col(c) - low) / span[2] * resolution), F.lit(resolution - 1)) if span[2] else F.lit(0)
    return place(y, span[1]) * resolution + place(x, span[0])


def levels(points: DataFrame, key: str, x: str, y: str, resolutions: list[int]) -> DataFrame:
    """points with lod: the first grid in which a point is the least key of a cell that no earlier level covers; the
    rest get the number of grids."""
    low = points.agg(F.min(x), F.min(y), F.greatest(F.max(x) - F.min(x), F.max(y) - F.min(y))).first()
    span = (low[0] or 0.0, low[1] or 0.0, low[2] or 0.0)
    each = [cells(points, x, y, r, span).alias(f"_cell{i}") for i, r in enumerate(resolutions)]
    out = points.withColumns({f"_cell{i}": c for i, c in enumerate(each)}).withColumn("lod", F.lit(None).cast("int"))
    for level in range(len(resolutions)):
        # the least key of each cell that no point of an earlier level is in; aggregated before the shuffle
        least = out.groupBy(f"_cell{level}").agg(F.min(key).alias("_first"), F.max(F.col("lod").isNotNull()).alias("_covered"))
        chosen = least.where("not _covered").select(F.col("_first").alias(key), F.lit(level).alias("_new"))
        out = stored(out.join(chosen, key, "left").withColumn("lod", F.coalesce("lod", "_new")).drop("_new"), "levels")
    return out.withColumn("lod", F.coalesce("lod", F.lit(len(resolutions)))).drop(*(f"_cell{i}" for i in range(len(resolutions))))


def coverage(points: DataFrame, lod: str, x: str, y: str, resolution: int) -> DataFrame:
    """(lod, coverage): the share of the occupied cells that each level and the levels before it reach."""
    low = points.agg(F.min(x), F.min(y), F.greatest(F.max(x) - F.min(x), F.max(y) - F.min(y))).first()
    span = (low[0] or 0.0, low[1] or 0.0, low[2] or 0.0)
    first = points.select(F.col(lod).alias("lod"), cells(points, x, y, resolution, span).alias("cell")).groupBy("cell").agg(F.min("lod").alias("first"))
    many = points.select(F.col(lod).alias("lod")).distinct().join(first.groupBy(F.col("first").alias("lod")).agg(F.count("*").alias("n")), "lod", "left")
    so_far = F.sum(F.coalesce("n", F.lit(0))).over(Window.orderBy("lod"))
    return many.select("lod", (so_far / F.sum("n").over(Window.partitionBy())).alias("coverage"))


def lod_cap(points: DataFrame, lod: str | None, order: str, most: int = 50_000) -> DataFrame:
    """Whole levels from the coarsest, then part of one in source order, ``most`` points in all; without levels every n-th point
    in source order, n the least that leaves ``most`` at most."""
    if lod is not None:
        return points.orderBy(lod, order).limit(most).orderBy(order)
    placed = dense_ids(points, [order], "_place")
    step = placed.agg(F.ceil(F.count("*") / most).alias("_step"))
    return placed.crossJoin(F.broadcast(step)).where(F.col("_place") % F.col("_step") == 0).drop("_place", "_step")


def detail(points: DataFrame, lod: str, rest: int, x: str, y: str, box: tuple[float, float, float, float], budget: int) -> DataFrame:
    """The points of the last level in a box, or none at all if they are more than the budget."""
    seen = points.where((F.col(lod) == rest) & in_box(F.col(x), F.col(y), box))
    return seen.limit(0) if seen.limit(budget + 1).count() > budget else seen
