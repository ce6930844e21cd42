"""Vectors as arrays, computed in double precision on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(v: Column) -> Column:
    """Unit length; a zero vector stays as it is."""
    length = norm(v)
    return F.when(length == 0, F.transform(v, lambda x: x.cast("double"))).otherwise(F.transform(v, lambda x: x.cast("double") / length))


def cosine(a: Column, b: Column) -> Column:
    """NULL where a vector is zero."""
    lengths = norm(a) * norm(b)
    return F.when(lengths > 0, dot(a, b) / lengths)


def vector_literal(v: Column) -> Column:
    """The text form ``[x,y,...]``; a missing vector is ``[]``."""
    return F.concat(F.lit("["), F.array_join(F.coalesce(v.cast("array<string>"), F.array().cast("array<string>")), ","), F.lit("]"))


def usable(v: Column, dim: int) -> Column:
    """Of the right length, finite in every value and not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) == dim) & finite & F.exists(v, lambda x: x != 0), F.lit(False))
