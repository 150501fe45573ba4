"""Word count over a directory of text files, maintained incrementally."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.keyed import word_count
from ..operators.shaping import flat_map_split


def word_count_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming ``(word, n)``: the batch line source, split and keyed count,
    on ``readStream``. Run with output mode ``complete`` (or ``update``);
    the running counts are Spark-managed state, one row per distinct word.
    Give the ``writeStream`` a ``checkpointLocation`` under the shared folder
    (``session.scratch_path``) so offsets and state survive lost executors
    and a restarted driver."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path)
    return word_count(flat_map_split(lines, "value", "\\s+", "word"))
