"""Column expressions on vectors held as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """The vector divided by its norm; a zero vector stays as it is."""
    n = norm(v)
    return F.when(n == 0, doubles(v)).otherwise(F.transform(v, lambda x: x.cast("double") / n))


def cosine(a: Column, b: Column) -> Column:
    """Null where either vector is zero."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))
