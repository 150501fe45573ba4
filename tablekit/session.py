"""Session construction and lineage cutting."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins and partition counts at
# run time, splits skewed join partitions and coalesces tiny shuffle outputs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tablekit", extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the defaults above.

    ``master`` and ``shuffle_partitions`` are only for local runs and tests;
    on a cluster the submitter decides both.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only a
    session in plain local mode, where driver and executors are one process,
    may leave it unset: it gets a folder of its own, removed when it ends.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(path)
        return path.rstrip("/")
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared folder")
    path = tempfile.mkdtemp(prefix="tablekit-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: one job,
    survives executor loss, and later readers read the columns they need."""
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a shuffle partition, from which more partitions than the session's are taken.
PARTITION_ROWS = 1 << 20
_sizing = threading.Lock()
_sized: dict[int, list] = {}


@contextmanager
def sized_shuffles(spark: SparkSession, rows: int) -> Iterator[int]:
    """While open, the session's shuffles have at least a partition for every
    ``PARTITION_ROWS`` of ``rows``, so that a task's sort or hash table doesn't grow with
    the input. Holds for what runs inside (``cut_lineage``), also in several threads; the
    session's own number comes back when the last one leaves. Yields the number."""
    key = "spark.sql.shuffle.partitions"
    with _sizing:
        before, users = _sized.get(id(spark), (spark.conf.get(key), 0))
        _sized[id(spark)] = [before, users + 1]
        number = max(int(spark.conf.get(key)), -(-rows // PARTITION_ROWS))
        spark.conf.set(key, str(number))
    try:
        yield number
    finally:
        with _sizing:
            before, users = _sized.pop(id(spark))
            if users > 1:
                _sized[id(spark)] = [before, users - 1]
            else:
                spark.conf.set(key, before)


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` does (Spark's file
    server hands the archive out). Once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_tablekit_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tablekit-code-"), "tablekit_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(archive)
    sc._tablekit_shipped = True
