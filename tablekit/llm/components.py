"""Connected components of a link table, each named by its smallest vertex."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import written


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("bigint")), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(vertex, component)`` for every vertex of an undirected link table, by
    alternating large and small stars until the edges stand still (a number of
    rounds logarithmic in the longest path). Minima are partial aggregates
    joined back, so a vertex with many links needs no task of its own."""
    u, v = F.col(a), F.col(b)
    edges = written(links.filter(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "cc")
    before = _mark(edges)
    while before[0]:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.union(least.filter("u <> m").select("u", F.col("m").alias("v"))).distinct()
        large = written(large, "cc-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        edges = written(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "cc-small")
        now = _mark(edges)
        if now == before:
            break
        before = now
    stars = edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("vertex"), "component")
    roots = edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return stars.union(roots)
