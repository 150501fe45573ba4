"""Sampling and splitting. Every random operator takes a seed, and decides by a
hash of a row's key, so that neither partitions nor retries change a sample."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import dense_index

# Lehmer generator modulus and multiplier.
PRIME = 2147483647
MULT = 48271


def seeded_hash(key: str | Column, seed: int) -> Column:
    """Integer hash in ``[0, 2^31 - 1)`` of an integer key and a seed, with
    no overflow (operands stay below 2^62); any SQL engine reproduces it."""
    k = F.col(key) if isinstance(key, str) else key
    x = F.pmod(F.pmod(k.cast("long"), F.lit(PRIME)) * MULT + seed, F.lit(PRIME))
    return F.pmod(x * MULT, F.lit(PRIME))


def mixed_finish(x: Column, seed: int) -> Column:
    """``mixed_hash`` of what ``seeded_hash`` gave."""
    return F.pmod(F.pmod(x * x + seed + 1, F.lit(PRIME)) * MULT, F.lit(PRIME))


def mixed_hash(key: str | Column, seed: int) -> Column:
    """``seeded_hash`` squared once on its way, so that neighbouring keys have
    nothing in common; still integers that any SQL engine reproduces."""
    return mixed_finish(seeded_hash(key, seed), seed)


def poisson_steps(mean: float) -> list[int]:
    """Thresholds of the hash: as many as it reaches is a Poisson count."""
    steps, term, total, k = [], math.exp(-mean), 0.0, 0
    while total < 1 - 0.5 / PRIME and k < 10 * mean + 100:
        total += term
        steps.append(math.ceil(min(total, 1.0) * PRIME))
        k += 1
        term *= mean / k
    return [t for t in steps if t < PRIME]


def sample_fraction(df: DataFrame, fraction: float, seed: int, key: str | Column, with_replacement: bool = False) -> DataFrame:
    """Each row with probability ``fraction``, by the hash of its integer ``key``; with
    replacement, as many times as a Poisson count of that mean, found by inverting its
    distribution at the hash. The size is random; the same rows come from any partitions."""
    h = mixed_hash(key, seed)
    if not with_replacement:
        return df.filter(h < int(fraction * PRIME))
    times = sum((F.when(h >= t, 1).otherwise(0) for t in poisson_steps(fraction)), F.lit(0))
    some = df.withColumn("_times", times).filter(F.col("_times") > 0)
    return some.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times", "_copy")


def sample_n_replace(df: DataFrame, n: int, seed: int, key: str, draw: str = "draw") -> DataFrame:
    """Exactly ``n`` rows drawn with replacement (none of an empty table), with the
    number of the ``draw``: hashed draw numbers name dense positions in the order of
    the unique integer ``key``."""
    places = dense_index(df.select(key), [key], name="_place")
    size = F.nullif(df.agg(F.count(F.lit(1))).scalar(), F.lit(0))
    number = F.col("id") + 1
    both = mixed_hash(number, seed) * PRIME + mixed_hash(number, seed + 1)
    draws = df.sparkSession.range(n).select(number.alias(draw), (F.pmod(both, size) + 1).alias("_place"))
    return draws.join(places, "_place").drop("_place").join(df, key).select(draw, *df.columns)


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """Exactly ``min(n, count)`` rows, repeatable: the ``n`` smallest seeded
    hashes of an integer key (a bounded top-n, no driver round trip)."""
    return df.orderBy(seeded_hash(key, seed), F.col(key)).limit(n)


def hash_bucket(key: str | Column, modulus: int = 100, multiplier: int = 7919) -> Column:
    """Stable integer bucket in ``[0, modulus)`` from an integer key."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(k.cast("long") * F.lit(multiplier), F.lit(modulus))


def hash_split(df: DataFrame, key: str, train_pct: int = 70, modulus: int = 100):
    """Deterministic split on a stable key: same rows every run and on every
    engine, disjoint and complete."""
    b = hash_bucket(key, modulus)
    return df.filter(b < train_pct), df.filter(b >= train_pct)


def random_split(df: DataFrame, weights: list[float], seed: int, key: list[str] | None = None):
    """Parts of the given weights, by a seeded hash of each row's ``key`` (all columns
    unless named; equal keys stay together). No row is sorted or written for it, and
    partitions, retries and the parts' order of reading change nothing."""
    h = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in key or df.columns]), F.lit(PRIME))
    ends = [math.ceil(PRIME * sum(weights[:i + 1]) / sum(weights)) for i in range(len(weights))]
    return [df.filter((h >= lo) & (h < hi)) for lo, hi in zip([0, *ends], ends)]
