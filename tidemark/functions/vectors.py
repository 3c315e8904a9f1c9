"""Vector arithmetic over array columns, in double precision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def as_vector(value: str | Column | Sequence[float]) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.col(value).cast("array<double>")
    return F.lit([float(x) for x in value])


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda total, x: total + x * x))


def cosine_similarity(a: Column, b: Column) -> Column:
    """0 where a vector has no length, null where one is null."""
    lengths = norm(a) * norm(b)
    return F.when(lengths == 0, 0.0).otherwise(F.try_divide(dot(a, b), lengths))


def l2_distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))
