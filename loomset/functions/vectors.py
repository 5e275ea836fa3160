"""Vector columns as array<float>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x
    )


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null when either vector has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def normalise(a: Column) -> Column:
    length = norm(a)
    return F.when(length > 0, F.transform(a, lambda x: x.cast("double") / length))


def is_usable(a: Column, dim: int) -> Column:
    """Right length and only finite numbers."""
    finite = F.forall(a, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(a) == dim) & finite, F.lit(False))
