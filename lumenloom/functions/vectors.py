"""Vector arithmetic on ARRAY<FLOAT|DOUBLE> columns, widened to double first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_DOUBLE = 1.7976931348623157e308


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: Column, b: Column) -> Column:
    """0 when a norm is zero or the sizes differ."""
    norms = norm(a) * norm(b)
    usable = (F.size(a) == F.size(b)) & (norms > 0)
    return F.when(usable, dot(a, b) / norms).otherwise(F.lit(0.0))


def euclidean_distance(a: Column, b: Column) -> Column:
    """The largest double when the sizes differ."""
    gap = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.when(F.size(a) == F.size(b), norm(gap)).otherwise(F.lit(MAX_DOUBLE))
