"""Matching-block similarity: the longest common block of two texts, then the
same on both sides of it, until nothing matches; twice the matched length over
the total length, from 0 to 1. Of the longest blocks the first of the left text is taken, at
its first place in the right one. Rows are compared batch by batch (``blocks``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_code
from .batches import batch_columns
from .blocks import matched_length
from .windows import code_points

# A right text of this length or more has popular characters,
# those that make up more than one in a hundred (and one more) of it; no block
# begins from them, though blocks found elsewhere go on over them.
POPULAR_FROM, POPULAR_SHARE = 200, 100
#: Stand for popular characters of the left and of the right text (no code points,
#: never equal to each other).
_LEFT, _RIGHT = -1, -2


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _popular(b: np.ndarray) -> np.ndarray:
    """The popular characters of the right text."""
    if len(b) < POPULAR_FROM:
        return b[:0]
    chars, often = np.unique(b, return_counts=True)
    return chars[often > len(b) // POPULAR_SHARE + 1]


def _ratios(a: pa.Array, b: pa.Array, forms: tuple[bool, ...]) -> list[pa.Array]:
    """``matching_ratio`` of two columns of an Arrow batch, with popular characters or without."""
    out = [[None] * len(a) for _ in forms]
    for row, (x, y) in enumerate(zip(a.to_pylist(), b.to_pylist())):
        if x is None or y is None:
            continue
        x, y, plain = code_points(x), code_points(y), None
        for values, popular in zip(out, forms):
            often = _popular(y) if popular else y[:0]
            if len(often):
                n = matched_length(x, y, np.where(np.isin(x, often), _LEFT, x), np.where(np.isin(y, often), _RIGHT, y))
            else:
                n = plain = matched_length(x, y, x, y) if plain is None else plain
            values[row] = 2.0 * n / (len(x) + len(y)) if len(x) + len(y) else 1.0
    return [pa.array(v, pa.float64()) for v in out]


def matching_ratio(a, b, popular: bool = True) -> Column:
    """``2 * matched / (len(a) + len(b))``; two empty texts give 1, a null text null.
    With ``popular``, characters that are popular in ``b`` begin no block."""
    ship_code(SparkSession.active())

    def ratio(x: pa.Array, y: pa.Array) -> pa.Array:
        return _ratios(x, y, (popular,))[0]
    return F.arrow_udf(ratio, "double")(_c(a), _c(b))


def with_matching_ratios(df: DataFrame, a: str, b: str, names: dict[str, bool]) -> DataFrame:
    """``df`` without the texts ``a`` and ``b``, with the ``matching_ratio`` of both under each
    name, with popular characters where its value is true."""
    forms = tuple(names.values())
    return batch_columns(df, [a, b], {n: "double" for n in names}, lambda x, y: _ratios(x, y, forms))
