"""Dense-vector column functions on ``array<float|double>`` (JVM higher-order
functions; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    """Sum of element products, accumulated left to right in double."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """Cosine similarity; NULL when either vector has zero length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def scale(a, s) -> Column:
    return F.transform(_c(a), lambda x: x.cast("double") * _c(s))


def normalize(a) -> Column:
    """Unit vector; NULL for a zero vector (it has no direction)."""
    return F.when(norm(a) > 0, scale(a, F.try_divide(F.lit(1.0), norm(a))))


def sq_dist(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double")) ** 2),
                       F.lit(0.0), lambda acc, x: acc + x)
