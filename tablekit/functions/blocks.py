"""Matched length of two texts by their longest common block and, on both sides of
it, the same again; one pair at a time."""

from __future__ import annotations

import numpy as np

# Cells of a region whose table of common runs is held at once; a larger
# region goes row by row.
TABLE_CELLS = 1 << 22


def _runs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``[i, j]``: length of the common run that ends at the i-th and the j-th character."""
    run = np.zeros((len(a) + 1, len(b) + 1), np.int32 if len(a) > 32000 else np.int16)
    same = a[:, None] == b[None, :]
    for i in range(len(a)):
        np.multiply(run[i, :-1] + 1, same[i], out=run[i + 1, 1:], casting="unsafe")
    return run


def _longest_by_rows(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    best, run = (0, 0, 0), np.zeros(len(b) + 1, np.int32)
    for i in range(len(a)):
        run[1:] = np.where(b == a[i], run[:-1] + 1, 0)
        j = int(run.argmax())
        if run[j] > best[2]:
            n = int(run[j])
            best = i + 1 - n, j - n, n
    return best


def matched_length(a: np.ndarray, b: np.ndarray, begin_a: np.ndarray, begin_b: np.ndarray) -> int:
    """``a`` and ``b`` by their code points; in ``begin_a`` and ``begin_b`` those that begin no
    block are numbers of their own, different on both sides. Of the longest blocks the
    first of the left text counts, at its first place in the right one; a block goes on
    over equal characters of ``a`` and ``b``."""
    matched, work = 0, [(0, len(a), 0, len(b), None, 0, 0)]
    ramp = np.arange(1, max(len(a), len(b)) + 1, dtype=np.int32)
    masked = begin_a is not a or begin_b is not b
    while work:
        alo, ahi, blo, bhi, table, ta, tb = work.pop()
        if alo >= ahi or blo >= bhi:
            continue
        if table is None and (ahi - alo) * (bhi - blo) <= TABLE_CELLS:
            # a table serves the regions inside its own
            table, ta, tb = _runs(begin_a[alo:ahi], begin_b[blo:bhi]), alo, blo
        if table is None:
            i, j, n = _longest_by_rows(begin_a[alo:ahi], begin_b[blo:bhi])
            i, j = alo + i, blo + j
        else:
            inside = table[alo - ta + 1:ahi - ta + 1, blo - tb + 1:bhi - tb + 1]
            if alo > ta or blo > tb:
                inside = np.minimum(inside, ramp[:ahi - alo, None].astype(table.dtype))
                np.minimum(inside, ramp[None, :bhi - blo].astype(table.dtype), out=inside)
            x, y = divmod(int(inside.argmax()), bhi - blo)
            n = int(inside[x, y])
            i, j = (alo + x + 1 - n, blo + y + 1 - n) if n else (alo, blo)
        if masked:
            while i > alo and j > blo and a[i - 1] == b[j - 1]:
                i, j, n = i - 1, j - 1, n + 1
            while i + n < ahi and j + n < bhi and a[i + n] == b[j + n]:
                n += 1
        if n:
            matched += n
            work += [(alo, i, blo, j, table, ta, tb), (i + n, ahi, j + n, bhi, table, ta, tb)]
    return matched
