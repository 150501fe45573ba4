"""Integer-sequence shaping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_sequences(col, maxlen: int, padding: str = "pre", truncating: str = "pre",
                  value: int = 0) -> Column:
    """Fixed-length sequences: truncate (keep the tail for ``pre``, the head
    for ``post``), then pad with ``value`` before (``pre``) or after."""
    a = F.col(col) if isinstance(col, str) else col
    if truncating == "pre":
        t = F.slice(a, F.greatest(F.size(a) - maxlen + 1, F.lit(1)), maxlen)
    else:
        t = F.slice(a, 1, maxlen)
    fill = F.array_repeat(F.lit(value), F.lit(maxlen) - F.size(t))
    return F.concat(fill, t) if padding == "pre" else F.concat(t, fill)


def collapse_flagged(tokens: Column, flags: Column, placeholder: str, keep_last: int) -> Column:
    """Replace every run of flagged tokens by one ``placeholder`` and keep the
    last ``keep_last`` tokens. A position is dropped when it and its right
    neighbour are both flagged."""
    n = F.size(tokens)
    kept = F.filter(F.sequence(F.lit(1), n),
                    lambda i: ~(F.element_at(flags, i)
                                & F.coalesce(F.try_element_at(flags, i + 1), F.lit(False))))
    out = F.transform(kept, lambda i: F.when(F.element_at(flags, i), F.lit(placeholder))
                      .otherwise(F.element_at(tokens, i)))
    out = F.when(n == 0, F.array().cast("array<string>")).otherwise(out)
    return F.slice(out, F.greatest(F.size(out) - keep_last + 1, F.lit(1)), keep_last)
