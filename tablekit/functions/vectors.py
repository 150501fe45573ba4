"""Dense-vector expressions on ``array<double>`` columns (sequential folds,
so results are repeatable)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _fold(u, v, f) -> Column:
    return F.aggregate(F.zip_with(_c(u), _c(v), f), F.lit(0.0), lambda acc, x: acc + x)


def dot(u, v) -> Column:
    return _fold(u, v, lambda a, b: a * b)


def norm(u) -> Column:
    return F.sqrt(F.aggregate(_c(u), F.lit(0.0), lambda acc, x: acc + x * x))


def sqeuclidean(u, v) -> Column:
    return _fold(u, v, lambda a, b: (a - b) * (a - b))


def euclidean(u, v) -> Column:
    return F.sqrt(sqeuclidean(u, v))


def cityblock(u, v) -> Column:
    return _fold(u, v, lambda a, b: F.abs(a - b))


def minkowski(u, v, p: float = 3.0) -> Column:
    return F.pow(_fold(u, v, lambda a, b: F.pow(F.abs(a - b), F.lit(p))), F.lit(1.0 / p))


def chebyshev(u, v) -> Column:
    return F.array_max(F.zip_with(_c(u), _c(v), lambda a, b: F.abs(a - b)))


def cosine(u, v) -> Column:
    """Cosine distance ``1 - u.v / (|u||v|)``; NULL with a zero vector."""
    return F.lit(1.0) - F.try_divide(dot(u, v), norm(u) * norm(v))


def braycurtis(u, v) -> Column:
    """``sum |a-b| / sum |a+b|``; NULL where the sums ``a+b`` are all zero."""
    return F.try_divide(cityblock(u, v), _fold(u, v, lambda a, b: F.abs(a + b)))


def canberra(u, v) -> Column:
    """Sum of ``|a-b| / (|a|+|b|)``; terms with a zero denominator count 0."""
    return _fold(u, v, lambda a, b: F.when((F.abs(a) + F.abs(b)) == 0, F.lit(0.0))
                 .otherwise(F.abs(a - b) / (F.abs(a) + F.abs(b))))


def jaccard(u, v) -> Column:
    """Boolean Jaccard distance on the non-zero pattern."""
    either = _fold(u, v, lambda a, b: F.when((a != 0) | (b != 0), F.lit(1.0)).otherwise(F.lit(0.0)))
    differ = _fold(u, v, lambda a, b: F.when(((a != 0) | (b != 0)) & (a != b), F.lit(1.0))
                   .otherwise(F.lit(0.0)))
    return F.when(either == 0, F.lit(0.0)).otherwise(differ / either)


def scale(u, by) -> Column:
    return F.transform(_c(u), lambda x: x * by)
