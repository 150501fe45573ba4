"""Session helpers of the corpus operators: shipping code, scratch tables, batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, ship_code

#: Text bytes that a task works on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
#: Rows of an Arrow batch (whole texts, some of them long).
BATCH_ROWS = 1000
ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Keys of 64 bits that are sent to every task; rows are shuffled to more.
BROADCAST_KEYS = 1 << 21


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` does (Spark's file
    server hands the archive out). Once per context. A session that leaves the
    rows of an Arrow batch at Spark's default gets ``BATCH_ROWS``: rows are whole
    texts here, and a batch is held several times over on either side."""
    if spark.conf.get(ROWS_SETTING, "10000") == "10000":
        spark.conf.set(ROWS_SETTING, str(BATCH_ROWS))
    ship_code(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir`` (a session
    in plain local mode that names none gets one of its own)."""
    return checkpoint_dir(spark)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage, survives lost executors and lets each reader prune columns."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: they go with the query that made
    them, not when the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def by_keys(rows: DataFrame, keys: DataFrame, how: str, key: str = "key") -> DataFrame:
    """Whole ``rows`` with (``left_semi``) or without (``left_anti``) those whose 64-bit
    ``key`` is in the table ``keys``. The rows stay where they are unless the keys are over ``BROADCAST_KEYS``."""
    small = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if small else keys, key, how)


def keep_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns only, so that extra or clashing columns of the input
    never meet an operator's own."""
    return df.select(*[df[f"`{n}`"] for n in names])


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A string column with nulls as empty texts."""
    col = batch.column(name)
    return col.fill_null("") if col.null_count else col


def slices(batch: pa.RecordBatch, name: str, max_bytes: int = SLICE_BYTES):
    """Cut a batch in runs of rows with at most ``max_bytes`` of text each (one
    row at least), so that a task's arrays stay small."""
    n = batch.num_rows
    if n == 0:
        return
    ends = np.cumsum(string_lengths(batch.column(name)))
    at = 0
    while at < n:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
        yield batch.slice(at, to - at)
        at = to


def joined(batches: Iterator[pa.RecordBatch], name: str, least_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have ``least_bytes`` of text, or all of them."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += int(string_lengths(batch.column(name)).sum())
        if size >= least_bytes:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def string_lengths(col: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc
    return pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def utf8_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes end to end and the ``len(col) + 1`` offsets."""
    if col.null_count:
        col = col.fill_null("")
    large = pa.types.is_large_string(col.type)
    offs = np.frombuffer(col.buffers()[1], np.int64 if large else np.int32)
    offs = offs[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


def list_array(values: np.ndarray, lengths, kind: pa.DataType) -> pa.ListArray:
    offs = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(values, kind))
