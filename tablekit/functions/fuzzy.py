"""Fuzzy string similarity on Levenshtein distance, 0-100 integers.

``ratio = round(100 * (L - lev) / L)`` with ``L`` the longer length (two
empty strings give 100). Token variants normalise first (lower case, runs of
non-alphanumerics to one space), then sort tokens or compare token sets.
``partial_ratio`` is the best ratio of the shorter text against every
window of the same length in the longer text (whole texts, no truncation).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_code
from .batches import batch_columns
from .text import split_ws
from .windows import code_points, least_window_distances


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ratio(a, b) -> Column:
    a, b = _c(a), _c(b)
    mx = F.greatest(F.length(a), F.length(b))
    return F.when(mx == 0, F.lit(100)).otherwise(
        F.round((mx - F.levenshtein(a, b)) * 100 / mx)).cast("int")


def ratio01(a, b) -> Column:
    """Similarity of two sequences from 0 to 1, ``1 - lev / L``; two empty ones
    give 1."""
    a, b = _c(a), _c(b)
    mx = F.greatest(F.length(a), F.length(b))
    return F.when(mx == 0, F.lit(1.0)).otherwise((mx - F.levenshtein(a, b)) / mx)


def fuzzy_tokens(col) -> Column:
    return split_ws(F.lower(F.regexp_replace(_c(col), "[^\\p{L}\\p{N}]+", " ")))


def token_sort_ratio(a, b) -> Column:
    return ratio(F.array_join(F.array_sort(fuzzy_tokens(a)), " "),
                 F.array_join(F.array_sort(fuzzy_tokens(b)), " "))


def token_set_ratio(a, b) -> Column:
    t1, t2 = fuzzy_tokens(a), fuzzy_tokens(b)
    inter = F.array_join(F.array_sort(F.array_intersect(t1, t2)), " ")
    d1 = F.array_join(F.array_sort(F.array_except(t1, t2)), " ")
    d2 = F.array_join(F.array_sort(F.array_except(t2, t1)), " ")
    s1 = F.trim(F.concat_ws(" ", inter, d1))
    s2 = F.trim(F.concat_ws(" ", inter, d2))
    return F.greatest(ratio(inter, s1), ratio(inter, s2), ratio(s1, s2))


def _partial_ratios(a: pa.Array, b: pa.Array) -> pa.Array:
    """``partial_ratio`` of two columns of an Arrow batch."""
    out, pairs, at = [None] * len(a), [], []
    for i, (x, y) in enumerate(zip(a.to_pylist(), b.to_pylist())):
        short, long_ = (x, y) if x is not None and y is not None and len(x) <= len(y) else (y, x)
        if short == "":
            out[i] = 0
        elif short is not None and long_ is not None:
            pairs.append((code_points(short), code_points(long_)))
            at.append(i)
    for i, (short, _), least in zip(at, pairs, least_window_distances(pairs)):
        # half up, as ROUND
        out[i] = (2 * (len(short) - least) * 100 + len(short)) // (2 * len(short))
    return pa.array(out, pa.int32())


def partial_ratio(a, b) -> Column:
    """The best window's ratio as a column expression; ``with_partial_ratio`` is the
    same for a table."""
    ship_code(SparkSession.active())
    return F.arrow_udf(_partial_ratios, "int")(_c(a), _c(b))


def with_partial_ratio(df: DataFrame, a: str, b: str, name: str = "partial_ratio") -> DataFrame:
    """``df`` without the texts ``a`` and ``b``, with the best ratio of the shorter one against
    every window of its length in the longer one: the distances to all windows come
    from one pass over a pair's table (``windows``), in blocks of pairs."""
    return batch_columns(df, [a, b], {name: "int"}, lambda x, y: [_partial_ratios(x, y)])
