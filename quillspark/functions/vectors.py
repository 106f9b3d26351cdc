"""Vector functions as column expressions over arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """Length 1; a zero vector stays as it is."""
    size = F.when(norm(a) == 0, 1.0).otherwise(norm(a))
    return F.transform(a, lambda x: x.cast("double") / size)


def cosine(a: Column, b: Column) -> Column:
    """0 if either vector is zero."""
    both = norm(a) * norm(b)
    return F.when(both == 0, 0.0).otherwise(dot(a, b) / both)


def angular(a: Column, b: Column) -> Column:
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine(a, b))))


def quantise(a: Column, largest: Column) -> Column:
    """Signed bytes: 127 x / largest, halves to even, clipped."""
    return F.transform(a, lambda x: F.greatest(F.lit(-127), F.least(F.lit(127), F.bround(x.cast("double") * 127.0 / largest))).cast("tinyint"))


def finite(a: Column) -> Column:
    """Whether a vector is there, is not empty and holds finite numbers only."""
    return F.coalesce((F.size(a) > 0) & F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
