"""Column expressions on array<float|double> vectors; arithmetic in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 when either vector has no length."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def has_dimension(a: Column, dim: int) -> Column:
    """The declared fixed length of a vector column, as a check."""
    return F.size(a) == dim
