"""Columns computed from Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import ship_code


def batch_columns(df: DataFrame, inputs: list[str], outputs: dict[str, str],
                  compute: Callable[..., list[pa.Array]]) -> DataFrame:
    """``df`` without the columns ``inputs``, with the columns ``outputs`` (name to type)
    that ``compute`` makes of the inputs' arrays, batch by batch."""
    ship_code(df.sparkSession)
    kept = [c for c in df.columns if c not in inputs]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in kept]
                       + [f"`{n}` {t}" for n, t in outputs.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = compute(*[batch.column(c) for c in inputs])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *made], [*kept, *outputs])

    return df.mapInArrow(run, schema)
