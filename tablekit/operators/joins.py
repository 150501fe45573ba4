"""Equi-joins, cogroup and join-back.

No explicit broadcast hints on inputs whose size grows with the data: the
optimizer broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (statically or at run time with AQE),
otherwise it shuffles; AQE splits skewed join partitions. Explicit broadcasts
are limited to inputs whose size is bounded by construction (a ``limit``, a
fixed dictionary, a per-bucket table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..session import cut_lineage

HOW = {"inner": "inner", "left": "left", "right": "right", "full": "full",
       "anti": "left_anti", "semi": "left_semi"}


def equi_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Inner/left/right/full/anti/semi join; ``on`` is a column name (key
    coalesced into one column) or a list of names."""
    return left.join(right, on, HOW[how])


def _chunked(df: DataFrame, key: str, v: str, chunk_size: int) -> DataFrame:
    """``(key, chunk, v)``: values numbered in sorted order within their key
    (a distributed grouped running count, so a hot key spreads over many
    tasks) and cut into chunks of ``chunk_size``."""
    from .ordering import grouped_running_sum
    one = df.select(key, F.col(v).alias("_v"), F.lit(1).alias("_one"))
    ranked = grouped_running_sum(one, [key], ["_v"], "_one", "_rank")
    return ranked.select(key, ((F.col("_rank") - 1) / chunk_size).cast("long").alias("chunk"), "_v")


def cogroup_many(key: str, sides: list, chunk_size: int = 1000) -> DataFrame:
    """n-way cogroup: ``sides`` is a list of ``(df, value_column, out_name)``;
    per key, one sorted list per side (empty when the side lacks the key).

    The lists are cut into rows ``(key, chunk, ...)`` of at most ``chunk_size``
    values per side (chunk ``i`` holds the ``i``-th run of each side's sorted
    values), so no row holds an unbounded list; keys below the size give one
    row with ``chunk = 0``. A NULL key is a key. The chunks of a key are
    shuffled by ``(key, chunk)``, so a hot key's fall to many tasks."""
    out = None
    for df, v, name in sides:
        chunks = _chunked(df, key, v, chunk_size).withColumnsRenamed({key: "_k", "chunk": "_c"})
        g = chunks.groupBy("_k", "_c").agg(F.array_sort(F.collect_list("_v")).alias(name))
        if out is None:
            out = g
            continue
        g = g.withColumnsRenamed({"_k": "_k2", "_c": "_c2"})
        out = (out.join(g, out["_k"].eqNullSafe(g["_k2"]) & (out["_c"] == g["_c2"]), "full")
               .withColumn("_k", F.coalesce("_k", "_k2")).withColumn("_c", F.coalesce("_c", "_c2")).drop("_k2", "_c2"))
    types = {name: df.schema[v].dataType for df, v, name in sides}
    return out.select(F.col("_k").alias(key), F.col("_c").alias("chunk"), *[F.coalesce(F.col(name), F.array().cast(ArrayType(types[name]))).alias(name)
                             for _, _, name in sides])


def cogroup(left: DataFrame, right: DataFrame, key: str, lv: str, rv: str,
            chunk_size: int = 1000) -> DataFrame:
    """Two-way cogroup: ``(key, chunk, left_values, right_values)``."""
    return cogroup_many(key, [(left, lv, "left_values"), (right, rv, "right_values")], chunk_size)


def join_back_mean(df: DataFrame, key: str, value: str, name: str = "group_mean") -> DataFrame:
    """Attach each group's mean to its rows (a NULL key is a group). The means,
    one row per key, are written first: both inputs of the join back are then
    plain shuffles, of which AQE splits a hot key's partition."""
    means = cut_lineage(df.groupBy(F.col(key).alias("_key")).agg(F.avg(value).alias(name)))
    return df.join(means, df[key].eqNullSafe(means["_key"]), "left").drop("_key")


def lookup_join(df: DataFrame, lookup: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join against a lookup table (a dictionary, a dimension such as nation).
    No hint: Spark broadcasts it by its measured bytes, statically or at run
    time, and shuffles beyond ``spark.sql.autoBroadcastJoinThreshold``."""
    return df.join(lookup, on, HOW[how])
