"""Key/value operators expressed on DataFrames with columns ``k`` and ``v``.

Every aggregate here is a hash aggregate with a partial (map-side) step, so a
key holding a third of the rows is combined on every mapper before the
shuffle and never gathered as a list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_count_mean(df: DataFrame, k: str = "k", v: str = "v") -> DataFrame:
    """``(sum, count)`` per key, then the mean — the tuple-reduce idiom."""
    return (df.groupBy(k)
              .agg(F.sum(v).alias("total"), F.count(F.lit(1)).alias("n"))
              .withColumn("mean", F.col("total") / F.col("n")))


def fold_by_key_max(df: DataFrame, zero, k: str = "k", v: str = "v", name: str = "folded") -> DataFrame:
    """``foldByKey(zero, max)``: the zero takes part, applied once per key."""
    return df.groupBy(k).agg(F.greatest(F.lit(zero), F.max(v)).alias(name))


def fold_sum(df: DataFrame, v: str, zero=0, name: str = "total") -> DataFrame:
    """``fold(zero, +)``: empty input gives ``zero`` (``reduce`` would raise)."""
    return df.agg((F.coalesce(F.sum(v), F.lit(0)) + F.lit(zero)).alias(name))


def word_count(words: DataFrame, word: str = "word", name: str = "n") -> DataFrame:
    return words.groupBy(word).agg(F.count(F.lit(1)).alias(name))


def count_by(df: DataFrame, key: Column | str, name: str = "key", count_name: str = "n") -> DataFrame:
    """``groupBy(function)``: group on an expression."""
    k = F.col(key) if isinstance(key, str) else key
    return df.groupBy(k.alias(name)).agg(F.count(F.lit(1)).alias(count_name))
