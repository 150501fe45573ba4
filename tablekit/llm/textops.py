"""Vectorised word and shingle hashing over the UTF-8 bytes of many texts."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

U = np.uint64
_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)
#: Bytes hashed at once; a single longer word takes another hash.
PIECE = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    if not _powers:
        for base in (_R, _R_INV):
            row = np.full(PIECE + 1, base, U)
            row[0] = 1
            _powers.append(np.multiply.accumulate(row))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def word_spans(buf: np.ndarray, offs: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` (or of the runs of
    bytes that the table ``apart`` doesn't mark) and, per text, the index of its
    first word (``len(offs)`` values; the last is the count)."""
    inside = ~apart[buf]
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    full = offs[:-1][offs[1:] > offs[:-1]]
    first[full] = inside[full]
    ends = offs[1:][offs[1:] > offs[:-1]] - 1
    last[ends] = inside[ends]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return s, e, np.searchsorted(s, offs)


def span_hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes: a polynomial from prefix sums,
    whatever the span's place in the buffer."""
    out = np.zeros(len(s), U)
    pw, inv = _tables()
    at, n = 0, len(s)
    while at < n:
        base = s[at]
        to = int(np.searchsorted(e, base + PIECE, "right"))
        if to == at:  # longer than a piece
            out[at] = int.from_bytes(blake2b(buf[s[at]:e[at]].tobytes(), digest_size=8).digest(), "little")
            at += 1
            continue
        part = buf[base:e[to - 1]]
        sums = np.zeros(len(part) + 1, U)
        np.cumsum((part.astype(U) + U(1)) * pw[:len(part)], out=sums[1:])
        a, b = s[at:to] - base, e[at:to] - base
        out[at:to] = mix((sums[b] - sums[a]) * inv[a] + (b - a).astype(U) * U(0xD6E8FEB86659FD93))
        at = to
    return out


def word_hashes(buf: np.ndarray, offs: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and, per text, the index of its first word."""
    s, e, first = word_spans(buf, offs)
    return span_hashes(_LOWER[buf] if lower else buf, s, e), first


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` words in a row (windows over text ends included: the
    caller leaves them out)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    h = words[:n].copy()
    for j in range(1, k):
        h = mix(h * U(0x9FB21C651E98DF25) + words[j:n + j])
    return mix(h + U(k))


def sequence_hash(words: np.ndarray) -> int:
    """Hash of a whole short word sequence, apart from every window's."""
    return int.from_bytes(blake2b(words.tobytes(), digest_size=8, person=b"sequence").digest(), "little")


def code_points(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Code points of each text."""
    lead = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=lead[1:])
    return lead[offs[1:]] - lead[offs[:-1]]
