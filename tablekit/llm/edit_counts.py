"""Edit-aware token counts.

A document's pre-tokens lie in the leaves of a segment tree, ``LEAF`` to a leaf
at first; each node has the sums of characters and of tokens below it. ``plant`` makes the
trees of a table once and keeps them as rows (text, leaves, and each pre-token's characters and
tokens); ``regrow`` applies scripts of edits to kept trees, without splitting or encoding what they don't
touch, and its rows are trees again that later edits can be applied to. An edit
(place, characters deleted, text inserted) descends the character sums to the
first pre-token that it can change, splits the new text from there, and stops
at the first boundary behind the edit that was a boundary before: the split is
decided from left to right, so all that follows is as it was. Only those
pre-tokens are encoded again; they replace the old ones in their leaves, and
the sums on the leaves' paths are updated. Leaves that have grown beyond ``LARGEST`` are
dealt out anew.

A match looks at most two characters past its end, so pre-tokens that end two
or more characters before the edit keep their place: that is the boundary
context. New pre-tokens of a batch are merged together, once each.

Null and empty texts are trees without leaves' contents and can be edited; null
edits are none; a null place or count is 0, a null insertion empty; places and
counts are cut to the text. Edits apply one after the other. Repeated rows
repeat their result; an empty table gives an empty one; extra columns are left
out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_bitmap import Coder, _Numbers, tokenizer_file
from .runtime import list_array, ship, slices, text_column

LEAF, LARGEST = 64, 1024
CONTEXT = 2
BATCH_BYTES = 4 << 20


class Sums:
    """A complete binary tree of sums over leaves."""

    def __init__(self, leaves: np.ndarray):
        size = 1
        while size < max(1, len(leaves)):
            size *= 2
        level = np.zeros(size, np.int64)
        level[:len(leaves)] = leaves
        self.levels = [level]
        while len(level) > 1:
            level = level[0::2] + level[1::2]
            self.levels.append(level)

    @property
    def total(self) -> int:
        return int(self.levels[-1][0])

    def put(self, leaf: int, value: int) -> int:
        """Set a leaf and update its path; the nodes touched."""
        self.levels[0][leaf] = value
        for k in range(1, len(self.levels)):
            leaf >>= 1
            below = self.levels[k - 1]
            self.levels[k][leaf] = below[2 * leaf] + below[2 * leaf + 1]
        return len(self.levels)

    def find(self, at: int) -> tuple[int, int]:
        """The leaf whose span has position ``at``, and the sum before it."""
        leaf, before = 0, 0
        for level in self.levels[-2::-1]:
            leaf *= 2
            if at - before >= level[leaf]:
                before += int(level[leaf])
                leaf += 1
        return leaf, before


class Document:
    """A kept tree: a text, its pre-tokens' characters and tokens, and the leaves' sizes.
    A pre-token is its number of tokens below zero, or, if an edit made it, its number among those to be
    encoded."""

    def __init__(self, text: str, lens: np.ndarray, toks: np.ndarray, leaves: np.ndarray, coder: Coder, numbers: dict):
        self.text, self.coder, self.numbers, self.redone = text, coder, numbers, 0
        self._deal(-np.asarray(toks, np.int64), np.asarray(lens, np.int64), np.asarray(leaves, np.int64))
        self.n_pieces = len(lens)
        self.paths = 0  # nodes updated

    def _deal(self, codes: np.ndarray, lens: np.ndarray, leaves: np.ndarray) -> None:
        self.flat = codes, lens
        self.at = np.concatenate(([0], np.cumsum(leaves))) if len(leaves) else np.zeros(2, np.int64)
        self.changed: dict[int, tuple[list, list]] = {}
        self.chars = Sums(self._sums(lens))

    def _sums(self, values: np.ndarray) -> np.ndarray:
        run = np.concatenate(([0], np.cumsum(values)))
        return run[self.at[1:]] - run[self.at[:-1]]

    @property
    def n_leaves(self) -> int:
        return len(self.at) - 1

    def leaf(self, j: int) -> tuple[list, list]:
        """The codes and characters of a leaf's pre-tokens."""
        if j in self.changed:
            return self.changed[j]
        codes, lens = self.flat
        a, b = self.at[j], self.at[j + 1]
        return codes[a:b].tolist(), lens[a:b].tolist()

    def edit(self, at: int, gone: int, new: str) -> None:
        old = self.text
        at = min(max(0, at), len(old))
        gone = min(max(0, gone), len(old) - at)
        self.text = old[:at] + new + old[at + gone:]
        # the first pre-token that ends less than CONTEXT characters before the edit
        leaf, start = self.chars.find(max(0, at - CONTEXT))
        if leaf >= self.n_leaves:
            leaf = self.n_leaves - 1
            start = len(old) - sum(self.leaf(leaf)[1])
        codes, lens = self.leaf(leaf)
        k = 0
        while k < len(lens) and start + lens[k] <= at - CONTEXT:
            start += lens[k]
            k += 1
        head_leaf, head, head_codes, head_lens = leaf, k, codes[:k], lens[:k]
        shift = len(new) - gone
        bound, pieces, here = start, [], start  # bound: an old boundary, here: a new one

        while True:
            while bound < here - shift or bound < at + gone:  # to the next old boundary that may do
                if k < len(lens):
                    bound += lens[k]
                    k += 1
                elif leaf + 1 < self.n_leaves:
                    self.n_pieces -= len(lens) - (head if leaf == head_leaf else 0)
                    leaf, k = leaf + 1, 0
                    codes, lens = self.leaf(leaf)
                else:
                    break
            if here >= at + len(new) and here - shift == bound:
                break
            if here >= len(self.text):
                break
            piece = self.coder.next_piece(self.text, here)
            pieces.append(piece)
            here += len(piece)
        self.n_pieces += len(pieces) - (k - (head if leaf == head_leaf else 0))
        self.redone += len(pieces)
        new_codes, new_lens = [self.numbers[p] for p in pieces], [len(p) for p in pieces]
        tail = codes[k:], lens[k:]
        for j in range(head_leaf, leaf + 1):
            own = (head_codes + new_codes, head_lens + new_lens) if j == head_leaf else ([], [])
            if j == leaf:
                own = own[0] + tail[0], own[1] + tail[1]
            self.changed[j] = own
            self.paths += self.chars.put(j, sum(own[1]))
        if len(self.changed[head_leaf][0]) > LARGEST:
            codes, lens, _ = self.flattened()
            self._deal(codes, lens, even(len(codes)))
            self.paths += 2 * len(self.chars.levels[0])

    def flattened(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes and characters of all pre-tokens, and the leaves' sizes."""
        if not self.changed:
            return *self.flat, np.diff(self.at)
        codes, lens, sizes, done = [], [], np.diff(self.at), 0
        for j in sorted(self.changed):
            a, b = self.at[j], self.at[j + 1]
            codes += [self.flat[0][done:a], np.array(self.changed[j][0], np.int64)]
            lens += [self.flat[1][done:a], np.array(self.changed[j][1], np.int64)]
            sizes[j], done = len(self.changed[j][0]), b
        return np.concatenate([*codes, self.flat[0][done:]]), np.concatenate([*lens, self.flat[1][done:]]), sizes

    def state(self, per_piece: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Characters and tokens of all pre-tokens, the leaves' sizes, and all tokens:
        the kept sums with the changed leaves'."""
        codes, lens, sizes = self.flattened()
        new = codes >= 0
        toks = -codes
        toks[new] = per_piece[codes[new]]
        return lens, toks, sizes, int(toks.sum())


def even(n: int) -> np.ndarray:
    """Sizes of the leaves of n pre-tokens dealt out evenly."""
    full, rest = divmod(n, LEAF)
    return np.array([LEAF] * full + [rest] * (rest > 0), np.int64)


_LISTS = ("lens", "toks", "leaves")
_TREE = "n_chars bigint, n_pieces bigint, n_tokens bigint, lens array<int>, toks array<int>, leaves array<int>"


def _lists(rows: list) -> pa.ListArray:
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return list_array(flat, [len(r) for r in rows], pa.int32())


def plant(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, pattern: str | None = None,
          carry: list[str] = ()) -> DataFrame:
    """``(key, text, *carry, n_chars, n_pieces, n_tokens, lens, toks, leaves)``: each text's
    tree, split and encoded once."""
    import public_tokenizers
    path, pattern = path or tokenizer_file(), pattern or public_tokenizers.PATTERN
    ship(df.sparkSession)
    src = df.select(df[f"`{key}`"].alias("key"), F.coalesce(df[f"`{text}`"], F.lit("")).alias("text"), *[df[f"`{c}`"] for c in carry])

    def run(batches):
        coder = Coder.of(path, pattern)
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                numbers, codes, lens = _Numbers(), [], []
                for t in text_column(part, "text").to_pylist():
                    pieces = coder.split(t)
                    codes.append(np.fromiter(map(numbers.__getitem__, pieces), np.int64, len(pieces)))
                    lens.append(np.fromiter(map(len, pieces), np.int64, len(pieces)))
                per_piece = np.diff(coder.merge([p.encode() for p in numbers])[1])
                toks = [per_piece[c] if len(c) else c for c in codes]
                cols = [pa.array([int(x.sum()) for x in lens], pa.int64()), pa.array([len(x) for x in lens], pa.int64()),
                        pa.array([int(x.sum()) for x in toks], pa.int64()), _lists(lens), _lists(toks), _lists([even(len(x)) for x in lens])]
                yield pa.RecordBatch.from_arrays([*part.columns, *cols], [*part.schema.names, "n_chars", "n_pieces", "n_tokens", *_LISTS])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema)
    return src.mapInArrow(run, f"{head}, {_TREE}").withColumnRenamed("key", key)


def _rows(col: pa.ListArray) -> list[np.ndarray]:
    values, ends = col.flatten().to_numpy(), np.cumsum([0, *col.value_lengths().fill_null(0).to_pylist()])
    return [values[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def regrow(trees: DataFrame, key: str = "doc_id", edits: str = "edits", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Kept trees with ``edits`` (an array of structs ``(at, gone, new)``) applied: ``(key, text, n_chars,
    n_pieces, n_tokens, lens, toks, leaves)``, trees as ``plant`` makes them, with ``old_chars, old_pieces, old_tokens,
    redone_pieces, updated_nodes``."""
    import public_tokenizers
    path, pattern = path or tokenizer_file(), pattern or public_tokenizers.PATTERN
    ship(trees.sparkSession)
    src = trees.select(trees[f"`{key}`"].alias("key"), "text", "n_chars", "n_pieces", "n_tokens", *_LISTS, trees[f"`{edits}`"].alias("edits"))
    old = ("old_chars", "old_pieces", "old_tokens", "redone_pieces", "updated_nodes")

    def run(batches):
        coder = Coder.of(path, pattern)
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                numbers, docs = _Numbers(), []
                for t, *tree, script in zip(part.column("text").to_pylist(), *(_rows(part.column(c)) for c in _LISTS), part.column("edits").to_pylist()):
                    d = Document(t, *tree, coder, numbers)
                    for e in script or ():
                        if e is not None:
                            d.edit(e["at"] or 0, e["gone"] or 0, e["new"] or "")
                    docs.append(d)
                per_piece = np.diff(coder.merge([p.encode() for p in numbers])[1])
                states = [d.state(per_piece) for d in docs]
                cols = [pa.array([d.text for d in docs], pa.string()), pa.array([d.chars.total for d in docs], pa.int64()),
                        pa.array([d.n_pieces for d in docs], pa.int64()), pa.array([s[3] for s in states], pa.int64()),
                        *[_lists([s[i] for s in states]) for i in range(3)], part.column("n_chars"), part.column("n_pieces"), part.column("n_tokens"),
                        pa.array([d.redone for d in docs], pa.int64()), pa.array([d.paths for d in docs], pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column("key"), *cols], ["key", "text", "n_chars", "n_pieces", "n_tokens", *_LISTS, *old])

    kind = src.schema["key"].dataType.simpleString()
    return src.mapInArrow(run, f"key {kind}, text string, {_TREE}, " + ", ".join(f"{n} bigint" for n in old)).withColumnRenamed("key", key)


def recount(trees: DataFrame, key: str = "doc_id", edits: str = "edits", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``(key, n_chars, n_pieces, n_tokens, edited_chars, edited_pieces, edited_tokens,
    redone_pieces, updated_nodes)``: the counts of kept trees before and after their edits."""
    return regrow(trees, key, edits, path, pattern).select(
        key, F.col("old_chars").alias("n_chars"), F.col("old_pieces").alias("n_pieces"), F.col("old_tokens").alias("n_tokens"),
        F.col("n_chars").alias("edited_chars"), F.col("n_pieces").alias("edited_pieces"), F.col("n_tokens").alias("edited_tokens"),
        "redone_pieces", "updated_nodes")


def sample_edits(text: str = "text"):
    """Three edits made of the text itself: its first words inserted in the
    middle, a run deleted after a third, and some characters replaced near the end."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    n = F.length(t)

    def one(at, gone, new):
        return F.struct(at.cast("int").alias("at"), F.lit(gone).alias("gone"), new.alias("new"))
    return F.array(one(F.floor(n / 2), 0, F.substring(t, 1, 23)), one(F.floor(n / 3), 31, F.lit("")),
                   one(F.floor(3 * n / 4), 7, F.substring(t, 5, 11)))
