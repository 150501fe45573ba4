"""Byte-level BPE by a hierarchical-bitmap rank queue.

The symbols of the pre-tokens form linked lists of byte positions. For each
merge rank there is a bucket of the positions whose pair has that rank; a
two-level bitmap marks the buckets in use, and find-first-set on it gives the
next rank in constant time. Positions whose pair has changed meanwhile are
stale and skipped when their bucket is met. A merge touches at most the two
neighbouring pairs, so a pre-token of n bytes costs O(n) pushes and pops
whatever its length.

One queue serves all distinct pre-tokens of a batch of texts: pre-tokens never
share a pair, so a bucket's merges in different pre-tokens are independent and
run as one array step. Within a pre-token a bucket's merges run from left to
right; where a merge could make a pair of a lower rank than its own, only the
leftmost merge of each pre-token runs before the queue is asked again.

Texts: null and empty texts give no ids; every other text is encoded whole.
Rows are independent: repeated rows repeat their result, extra columns of the
input are left out, and an empty table gives an empty one.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from hashlib import sha256
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .runtime import keep_columns, ship, slices, text_column, utf8_bytes

_LEAF = 256
#: Text bytes whose pre-tokens share a queue.
BATCH_BYTES = 4 << 20


def tokenizer_file(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def load_ranks(path: str) -> dict[bytes, int]:
    """A ``.tiktoken`` file: base64 token and rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


#: The public pattern's branches: contractions, letters and numbers, all else.
_SHORT, _WORDS, _REST = "'s|'t|'re|'ve|'m|'ll|'d|", r" ?\p{L}+| ?\p{N}+|", r" ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def letters_first(pattern: str) -> str:
    """The same matches with the letter and number branches tried first: no
    contraction begins like one of them, and most matches are words."""
    return _WORDS + _SHORT + pattern[len(_SHORT + _WORDS):] if pattern.startswith(_SHORT + _WORDS) else pattern


def code_point_kinds() -> np.ndarray:
    """0 to 3 for each code point: other, letter, number, white space, as ``regex`` has them."""
    import regex
    every, out = "".join(map(chr, range(0x110000))), np.zeros(0x110000, np.uint8)
    for k, one in enumerate((r"\p{L}+", r"\p{N}+", r"\s+"), 1):
        for m in regex.finditer(one, every):
            out[m.start():m.end()] = k
    return out


class RankQueue:
    """Buckets of positions by rank, and a two-level bitmap over the ranks."""

    def __init__(self):
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.leaves: dict[int, int] = {}
        self.top = 0

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        if len(ranks) > 1:
            # numbers of 16 bits are sorted by their digits
            order = np.argsort(ranks.astype(np.uint16) if ranks.max() < 1 << 16 else ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for a, b in zip(cuts, cuts[1:]):
            r, part = int(ranks[a]), positions[a:b]
            if r in self.buckets:
                self.buckets[r].append(part)
            else:
                self.buckets[r] = [part]
                w = r // _LEAF
                self.leaves[w] = self.leaves.get(w, 0) | 1 << r % _LEAF
                self.top |= 1 << w

    def pop(self) -> tuple[int, np.ndarray]:
        w = (self.top & -self.top).bit_length() - 1
        leaf = self.leaves[w]
        r = w * _LEAF + (leaf & -leaf).bit_length() - 1
        leaf &= leaf - 1
        self.leaves[w] = leaf
        if not leaf:
            self.top &= self.top - 1
        parts = self.buckets.pop(r)
        return r, parts[0] if len(parts) == 1 else distinct(np.concatenate(parts))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values (``x`` is sorted in place)."""
    x.sort()
    keep = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=keep[1:])
    return x[keep]


class Coder:
    """Encodes and decodes with one rank file and split pattern."""

    _made: dict[tuple[str, str], "Coder"] = {}

    def __init__(self, path: str, pattern: str):
        import regex
        self.ranks = ranks = load_ranks(path)
        self.pattern = regex.compile(letters_first(pattern))
        self.split = self.pattern.findall
        self.byte_rank = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, r in ranks.items():
            tokens[r] = token
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_at = np.zeros(len(tokens) + 1, np.int64)
        np.cumsum([len(t) for t in tokens], out=self.token_at[1:])
        pairs = {}
        for token, r in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = r
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        #: For the public pattern: kinds of code points, made when first asked for.
        self.by_kinds, self.kinds = pattern == _SHORT + _WORDS + _REST, None
        #: Ranks of all pairs of single bytes.
        self.byte_pairs = self.pair_ranks(np.repeat(self.byte_rank, 256), np.tile(self.byte_rank, 256)).reshape(256, 256)
        bytes_first = np.sort(self.byte_rank)
        high = np.maximum(self.keys >> 32, self.keys & 0xFFFFFFFF)
        odd = (self.merged < high) & ~np.isin(high, bytes_first)
        #: Ranks whose merge may make a pair of a lower rank.
        self.unordered = set(high[odd].tolist())

    @classmethod
    def of(cls, path: str, pattern: str) -> "Coder":
        """The worker's coder for this file and pattern, made once."""
        if (path, pattern) not in cls._made:
            cls._made[path, pattern] = cls(path, pattern)
        return cls._made[path, pattern]

    def next_piece(self, text: str, at: int) -> str:
        """The pre-token that begins at a place where one ends or none has begun."""
        return self.pattern.match(text, at).group()

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 where they don't merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], -1)

    def makes_lower(self, r: int, pos, sym, nxt, prv, stop) -> bool:
        """Whether a merge at ``pos`` may make a pair of a rank below ``r``."""
        left = sym[prv[pos[~stop[pos]]]]
        after = nxt[nxt[pos]]
        right = sym[after[~stop[after]]]
        a = np.concatenate((left, np.full(len(right) + 1, r)))
        b = np.concatenate((np.full(len(left), r), right, [r]))
        got = self.pair_ranks(a, b)
        return bool(((got >= 0) & (got < r)).any())

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces end to end, and where each piece's ids begin (one
        value more than pieces)."""
        lens = np.array([len(p) for p in pieces], np.int64)
        at = np.zeros(len(pieces) + 1, np.int64)
        np.cumsum(lens, out=at[1:])
        n = int(at[-1])
        if not n:
            return np.zeros(0, np.int64), at
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        sym = self.byte_rank[raw]
        nxt = np.arange(1, n + 1)
        prv = np.arange(-1, n)
        stop = np.zeros(n + 1, bool)  # a piece begins here
        stop[at] = True
        alive = np.ones(n, bool)
        pair = np.full(n, -1, np.int64)
        whole = np.array([self.ranks.get(p, -1) for p in pieces], np.int64)
        known = np.flatnonzero((whole >= 0) & (lens > 0))
        todo = np.repeat(whole < 0, lens)
        ready = np.flatnonzero(todo[:-1] & ~stop[1:-1])
        pair[ready] = self.byte_pairs[raw[ready], raw[ready + 1]]
        alive[~todo] = False
        alive[at[known]] = True
        sym[at[known]] = whole[known]
        queue = RankQueue()
        ready = ready[pair[ready] >= 0]
        if len(ready):
            queue.push(pair[ready], ready)
        while queue.top:
            r, pos = queue.pop()
            pos = pos[pair[pos] == r]
            if not len(pos):
                continue
            if len(pos) > 1:
                if r in self.unordered and self.makes_lower(r, pos, sym, nxt, prv, stop):
                    first = np.unique(np.searchsorted(at, pos, "right"), return_index=True)[1]
                    if len(first) < len(pos):
                        rest = np.delete(pos, first)
                        queue.push(np.full(len(rest), r), rest)
                        pos = pos[first]
                touch = nxt[pos[:-1]] == pos[1:]
                if touch.any():  # of a run of overlapping pairs, every other one
                    k = np.arange(len(pos))
                    begin = np.maximum.accumulate(np.where(np.concatenate(([False], touch)), 0, k))
                    pos = pos[(k - begin) % 2 == 0]
            gone = nxt[pos]
            after = nxt[gone]
            sym[pos] = r
            nxt[pos] = after
            prv[after] = pos
            pair[gone] = -1
            alive[gone] = False
            before = prv[pos[~stop[pos]]]
            near = distinct(np.concatenate((before, pos))) if len(before) else pos
            right = nxt[near]
            open_ = ~stop[right]
            pair[near[~open_]] = -1
            near, right = near[open_], right[open_]
            if len(near):
                new = self.pair_ranks(sym[near], sym[right])
                pair[near] = new
                some = new >= 0
                if some.any():
                    queue.push(new[some], near[some])
        before = np.zeros(n + 1, np.int64)
        np.cumsum(alive, out=before[1:])
        return sym[alive], before[at]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids (unsigned 32-bit) of all texts end to end, and where each text's
        begin: each distinct pre-token is merged once."""
        seen = _Numbers()
        codes, ends = [], [0]
        for t in texts:
            got = np.fromiter(map(seen.__getitem__, self.split(t)), np.int64)
            codes.append(got)
            ends.append(ends[-1] + len(got))
        ids, at = self.merge([p.encode() for p in seen])
        codes = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        flat, begin = gather(ids.astype("<u4"), at, codes)
        return flat, begin[np.array(ends)]

    def pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pre-tokens (binary) of a column's texts end to end, and where each text's end. For the
        public pattern they are found by the kinds of code points, in all texts at once."""
        if not self.by_kinds:
            found = [self.split(t or "") for t in texts.to_pylist()]
            return pa.array([p.encode() for f in found for p in f], pa.binary()), np.cumsum([len(f) for f in found], dtype=np.int64)
        if self.kinds is None:
            self.kinds = code_point_kinds()
        raw, offs = utf8_bytes(texts)
        if not len(raw):
            return pa.array([], pa.binary()), offs[1:]
        byte = np.flatnonzero(raw & 0xC0 != 0x80)  # where code points begin
        raw, ends = raw.tobytes(), np.searchsorted(byte, offs)
        code = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        n = len(code)
        kind = self.kinds[code]
        white, text = kind == 3, np.zeros(n + 3, bool)  # text: one begins here
        text[ends] = True
        start = np.zeros(n + 3, bool)
        start[1:n] = kind[1:] != kind[:-1]
        # white space before something else leaves its last character to it; a space is joined with it
        last = white[:-1] & ~white[1:] & ~text[1:n]
        start[:n - 1] |= last
        start[1:n] &= ~(last & (code[:-1] == 32))
        start |= text
        mark = np.flatnonzero(start[:n - 1] & (code[:-1] == 39) & ~text[1:n])
        after = code[mark + 1]
        second = np.where(text[mark + 2], 0, code[np.minimum(mark + 2, n - 1)])
        one, two = np.isin(after, (100, 109, 115, 116)), (second == 101) & np.isin(after, (114, 118)) | (second == 108) & (after == 108)
        start[mark[one | two] + 1] = False
        start[mark[one] + 2] = start[mark[two] + 3] = True
        at = np.flatnonzero(start[:n])
        begin = np.append(byte[at], len(raw)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(begin), pa.py_buffer(raw)]), np.searchsorted(at, ends[1:])

    def encode_at_once(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode`` for a column, with the pre-tokens found by ``pieces`` in runs of about
        ``SLICE_BYTES`` and one queue for all of them."""
        found, ends = [pa.array([], pa.binary())], [np.zeros(1, np.int64)]
        for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
            own, to = self.pieces(part.column("text"))
            found.append(own)
            ends.append(to + ends[-1][-1])
        coded = pa.concat_arrays(found).dictionary_encode()
        ids, at = self.merge(coded.dictionary.to_pylist())
        flat, begin = gather(ids.astype("<u4"), at, coded.indices.to_numpy())
        return flat, begin[np.concatenate(ends)]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids end to end, and where each id's begin."""
        return gather(self.token_bytes, self.token_at, ids)


class _Numbers(defaultdict):
    """Numbers its keys in the order of their first use."""

    def __init__(self):
        super().__init__(count().__next__)


def gather(values: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a ragged array end to end, and where each begins (and the end)."""
    lens = at[rows + 1] - at[rows]
    begin = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(lens, out=begin[1:])
    take = np.arange(begin[-1]) + np.repeat(at[rows] - begin[:-1], lens)
    return values[take], begin


def encode_column(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
                  pattern: str | None = None, with_ids: bool = True, slice_bytes: int = BATCH_BYTES) -> DataFrame:
    """``(key, n_tokens, ids_sha256, decoded_sha256[, ids])``: each text encoded
    by the rank queue and decoded again. ``ids`` is binary, little-endian
    unsigned 32-bit integers; ``path`` must name a file on every executor (the
    tokenizer package is installed there). ``slice_bytes``: of text that a task
    encodes at once; smaller slices take less memory and share fewer pre-tokens."""
    import public_tokenizers
    path = path or tokenizer_file()
    pattern = pattern or public_tokenizers.PATTERN
    ship(df.sparkSession)
    src = keep_columns(df, [key, text]).toDF("key", "text")
    kind = src.schema["key"].dataType.simpleString()

    def run(batches):
        coder = Coder.of(path, pattern)
        for batch in batches:
            for part in slices(batch, "text", slice_bytes):
                ids, at = coder.encode(text_column(part, "text").to_pylist())
                coded, decoded, kept = [], [], []
                for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                    own = ids[a:b]
                    raw = own.tobytes()
                    coded.append(sha256(raw).hexdigest())
                    decoded.append(sha256(coder.decode(own)[0].tobytes()).hexdigest())
                    if with_ids:
                        kept.append(raw)
                cols = [part.column("key"), pa.array(np.diff(at), pa.int64()), pa.array(coded, pa.string()),
                        pa.array(decoded, pa.string())]
                names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols.append(pa.array(kept, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    out = src.mapInArrow(run, schema + (", ids binary" if with_ids else ""))
    return out.withColumnRenamed("key", key)
