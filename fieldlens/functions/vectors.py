"""Dense vector arithmetic on arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldlens.functions.projection import let


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, v: acc + v
    )


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, NaN when a vector has no length."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(float("nan")))


def l2_pad(vector: Column, dim: int) -> Column:
    """Cut or zero-pad to ``dim``, then scale to unit length; zero vectors stay zero."""
    padded = F.slice(F.concat(vector.cast("array<double>"), F.array_repeat(F.lit(0.0), dim)), 1, dim)

    def scaled(v):
        return let(norm(v), lambda n: F.transform(v, lambda x: F.when(n > 0, x / n).otherwise(x)))

    return let(padded, scaled)
