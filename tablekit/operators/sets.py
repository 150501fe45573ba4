"""Bag and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*dfs: DataFrame, by_name: bool = True) -> DataFrame:
    """Bag union (duplicates kept); aligned by name unless ``by_name=False``."""
    return reduce(lambda a, b: a.unionByName(b) if by_name else a.union(b), dfs)


def _null_safe_all(a: DataFrame, b: DataFrame):
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in a.columns])


def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Set intersection: distinct rows present on both sides. Both sides are
    de-duplicated first (partial aggregation combines a hot value on every
    mapper), then semi-joined."""
    da, db = a.distinct(), b.distinct()
    return da.join(db, _null_safe_all(da, db), "left_semi")


def subtract_keep_duplicates(a: DataFrame, b: DataFrame) -> DataFrame:
    """``rdd.subtract``: every row of ``a`` (duplicates kept) whose value does
    not occur in ``b``. NULL-safe equality on all columns; ``b`` is
    de-duplicated before the anti join."""
    db = b.distinct()
    return a.join(db, _null_safe_all(a, db), "left_anti")
