"""Dense-vector arithmetic as native array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("array<double>")


def total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null when one of them is all zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def max_abs(a: Column) -> Column:
    return F.array_max(F.transform(a, lambda x: F.abs(x)))
