"""Text and CSV readers, local-collection and range sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .csv_records import read_csv_records


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One row per line (column ``value``); a glob reads every matching file."""
    df = spark.read.text(path)
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        df = df.repartition(min_partitions)
    return df


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``(path, content)``."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"),
                    F.col("value").alias("content")))


def read_csv_typed(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",",
                   header: bool = True, multi_line: bool = False, quote: str = '"',
                   escape: str = '"') -> DataFrame:
    """CSV with an explicit schema (the recommended mode: no inference pass).
    ``multi_line`` allows line breaks in quoted values (``csv_records``: a file is
    still read in splits)."""
    if multi_line:
        return read_csv_records(spark, path, schema, sep, header, quote, escape)
    return spark.read.csv(path, schema=schema, sep=sep, header=header,
                          quote=quote, escape=escape)


def read_csv_inferred(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
                      sampling_ratio: float = 1.0, multi_line: bool = False) -> DataFrame:
    """CSV with type inference. Inference is an extra pass over the data; lower
    ``sampling_ratio`` on large inputs."""
    return spark.read.csv(path, sep=sep, header=header, inferSchema=True,
                          samplingRatio=sampling_ratio, multiLine=multi_line,
                          escape='"')


def read_csv_strings(spark: SparkSession, path: str, casts: dict[str, str] | None = None,
                     sep: str = ",", encoding: str = "utf-8", multi_line: bool = False,
                     keep_raw: bool = False) -> DataFrame:
    """CSV read with header only (every column a string), then ``try_cast`` of
    the named columns, so malformed values become NULL instead of failing.
    ``keep_raw`` keeps each cast column's text as ``<name>_raw``."""
    df = spark.read.csv(path, sep=sep, header=True, encoding=encoding,
                        multiLine=multi_line, escape='"')
    for name, typ in (casts or {}).items():
        if keep_raw:
            df = df.withColumn(f"{name}_raw", F.col(name))
        df = df.withColumn(name, F.col(name).try_cast(typ))
    return df


def range_source(spark: SparkSession, start: int, end: int | None = None, step: int = 1,
                 num_partitions: int | None = None) -> DataFrame:
    """Distributed integer range (column ``id``); generated on the executors."""
    return spark.range(start, end, step, num_partitions)


def rows_source(spark: SparkSession, rows, schema=None) -> DataFrame:
    """Small local collection -> DataFrame. Names inferred (``_1, _2, ...``),
    given as a list, or a full ``StructType``. For small literal data only."""
    return spark.createDataFrame(rows, schema)
