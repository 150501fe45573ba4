"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, data_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; naming columns here keeps the scan's ReadSchema narrow."""
    df = spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Spread rows over the cluster's cores before costly row-local work
    (text normalisation, tokenising, sentence splitting) when the scan yields
    fewer splits than there are cores, as a few large files or row groups do.
    Hash partitioning on a unique key keeps the placement deterministic for
    task retries. A large input already has at least that many splits and is
    returned unchanged, so no shuffle is added at scale."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys) if keys else df.repartition(cores)


def scatter_rows(df: DataFrame, *keys: str, per_core: int = 4) -> DataFrame:
    """Hash-partition rows on ``keys`` to several tasks a core, for work that is
    quadratic in a row's texts: ranges of an order hold like numbers of rows, not
    like work, and a small frame's ranges would be joined to a few tasks. The
    texts' shuffle is linear, so it costs little beside such work at any size."""
    spark = df.sparkSession
    tasks = max(per_core * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *keys)


def read_spread(spark: SparkSession, data_dir: str, name: str, key: str, *columns: str) -> DataFrame:
    """``read_table`` followed by ``spread_rows`` on the table's unique ``key``."""
    return spread_rows(read_table(spark, data_dir, name, *columns), key)
