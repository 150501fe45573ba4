"""Levenshtein distances of a text to every window of its own length in another
text, for many pairs at once.

Unit costs are an alignment of the texts with a common letter before each character
(a substitution keeps the letter, a match both), and the alignments of one text with
all substrings of another are one braid: a strand enters at every row and column of
the table, two strands that have met once don't cross again, and the distance to a
window is the number of strands that both enter above it and leave below it. So all windows
take one pass over the table, in place of a table each. Cells of a diagonal
don't depend on each other; they are worked off together, for a block of pairs.
"""

from __future__ import annotations

import numpy as np

# Pairs of a block, and rows times pairs that a block has at most
# (its arrays stay in a core's cache; a longer text is a block of its own).
BLOCK_PAIRS, BLOCK_CELLS = 64, 1 << 15


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.int32)


def _block(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[int]:
    """The least distance of each pair's first text (not empty, not the longer one)."""
    k = len(pairs)
    rows, cols = np.array([len(a) for a, _ in pairs]), np.array([len(b) for _, b in pairs])
    m, n = int(rows.max()), int(cols.max())
    kind = np.int16 if 2 * (m + n) < 32000 else np.int32
    a, b = np.full((m, k), -1, np.int32), np.full((n, k), -2, np.int32)  # b from its end
    for p, (x, y) in enumerate(pairs):
        a[:len(x), p], b[n - len(y):, p] = x, y[::-1]
    # strands by number: rows from below, then columns; two for each character
    number = np.arange(m, dtype=kind)[:, None]
    left_a, left_b = np.repeat(-1 - 2 * number, k, 1), np.repeat(-2 - 2 * number, k, 1)
    now_a, now_b, new_a, new_b = (np.empty((m + 1, k), kind) for _ in range(4))
    low_a, low_b, high_a, high_b = (np.empty((m, k), kind) for _ in range(4))
    same = np.empty((m, k), bool)
    out_a, out_b = np.empty((m + n, k), kind), np.empty((m + n, k), kind)
    below, each = rows, np.arange(k)
    if len(set(rows.tolist())) == 1:
        below, each = int(rows[0]), slice(None)
    for d in range(m + n - 1):  # row i meets column d - i
        lo, hi = max(0, d - n + 1), min(m, d + 1)
        now_a[0], now_b[0] = 2 * min(d, n), 2 * min(d, n) + 1
        s, after, size = slice(lo, hi), slice(lo + 1, hi + 1), hi - lo
        la, lb, ha, hb, eq = low_a[:size], low_b[:size], high_a[:size], high_b[:size], same[:size]
        np.equal(a[s], b[n - 1 - d + lo:n - 1 - d + hi], out=eq)
        # letter to letter: both turn; letter to character and character to letter
        np.maximum(now_a[s], now_b[s], out=hb)
        np.minimum(left_b[s], left_a[s], out=la)
        np.maximum(left_b[s], left_a[s], out=new_a[after])
        np.minimum(now_a[s], now_b[s], out=left_a[s])
        # character to character: turn if equal, else the larger one goes down
        np.minimum(la, hb, out=lb)
        np.maximum(la, hb, out=ha)
        left_b[s] = np.where(eq, hb, lb)
        new_b[after] = np.where(eq, la, ha)
        out_a[d], out_b[d] = new_a[below, each], new_b[below, each]
        now_a, new_a, now_b, new_b = new_a, now_a, new_b, now_b
    least = []
    for p in range(k):
        r, c = int(rows[p]), int(cols[p])
        ends = np.stack([out_a[r - 1:r - 1 + c, p], out_b[r - 1:r - 1 + c, p]], 1).astype(np.int64)
        # a strand from character x to y counts in the windows that begin from y - r + 1 to x
        to, start = np.divmod(np.arange(2 * c), 2)[0], ends.ravel() // 2
        first = np.maximum(to - r + 1, 0)
        last = np.minimum(start, c - r)
        holds = (ends.ravel() >= 0) & (first <= last)
        change = np.bincount(first[holds], minlength=c + 2) - np.bincount(last[holds] + 1, minlength=c + 2)
        least.append(int(np.cumsum(change)[:c - r + 1].min()))
    return least


def least_window_distances(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[int]:
    """For each pair of code points (the first not empty and not longer than the
    second) the least distance to a window. Pairs of like size share a block."""
    order = sorted(range(len(pairs)), key=lambda i: (len(pairs[i][0]), len(pairs[i][1])))
    least, at = [0] * len(pairs), 0
    while at < len(order):
        to = at + 1
        while to < len(order) and to - at < BLOCK_PAIRS and (to + 1 - at) * len(pairs[order[to]][0]) <= BLOCK_CELLS:
            to += 1
        for i, value in zip(order[at:to], _block([pairs[i] for i in order[at:to]])):
            least[i] = value
        at = to
    return least
