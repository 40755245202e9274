"""Vector expressions on arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 for null, empty, unequal or zero ones."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    able = (F.size(a) == F.size(b)) & (F.size(a) > 0) & (size > 0)
    return F.coalesce(F.when(able, dot(a, b) / size), F.lit(0.0))
