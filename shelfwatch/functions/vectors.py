"""Vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine_clip(a: Column, b: Column) -> Column:
    """Cosine of two vectors, negative values as 0 and at most 1; a zero vector scores 0.

    Null where a vector is missing or the lengths differ.
    """
    norm = F.sqrt(_dot(a, a) * _dot(b, b))
    cosine = F.when(norm == 0, F.lit(0.0)).otherwise(F.try_divide(_dot(a, b), norm))
    clipped = F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0))
    return F.when((F.size(a) == F.size(b)) & cosine.isNotNull(), clipped)
