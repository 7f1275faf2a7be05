"""Dense vector helpers over array<double> columns (JVM higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_double_array(x) -> Column:
    return _c(x).cast("array<double>")


def dot(a, b) -> Column:
    a, b = as_double_array(a), as_double_array(b)
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """Cosine of two vectors; a zero-norm side gives 0.0."""
    den = norm(a) * norm(b)
    return F.when(den == 0, F.lit(0.0)).otherwise(dot(a, b) / den)


def l2_normalise(a) -> Column:
    """Scale to unit length; an all-zero vector stays zero.

    The norm is an argument of ``zip_with`` (evaluated once per row), not an
    expression inside the per-element lambda (which would re-run it per element).
    """
    a = as_double_array(a)
    return F.zip_with(a, F.array_repeat(norm(a), F.size(a)),
                      lambda x, n: F.when(n == 0, x).otherwise(x / n))
