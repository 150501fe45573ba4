"""Spelling variant grouping by a frequency-vector trie.

Two words are near if one inserted, deleted or replaced code point makes one of
the other. Such an edit changes a word's vector of letter-group counts by one
surplus and one deficit at most, so the words are arranged in a trie by their
successive counts, rare letters first, and a depth-first search with a budget of
one surplus and one deficit finds every word whose vector fits. Words at the
leaves are verified.

The trie's top levels, the counts of four coarse letter groups (their sum is the
length), are Spark's partitioning: a word is sent to the at most 11 top nodes
that its budget reaches (its own, six of the same length, four one longer), so that each pair
meets once, the shorter word searching for the longer. A top node of many words is cut into cells of
at most ``TRIE_WORDS`` words and about ``QUERY_WORDS`` searching words, by hash; each cell
is a trie of its own with the levels below. Tasks read a cell's words, then its
searching words in blocks, and send one row for each word that met another:
how many, and the most frequent one.

A word's form is its near word of the largest count (ties: the smallest in code
point order) if that count is at least ``ratio`` times the word's own. A root is
where following forms ends; counts rise along them, so there is no circle.

Null texts have no words, null keys count as an empty string where a caller
hashes them. Repeated rows count as often as they occur. Empty tables give
empty ones; other columns are never read. Words of any length and any alphabet
are searched whole: letters other than a to z share six groups.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import ship, written

#: Coarse groups at the top of the trie; all other letters are the fourth.
TOP = ("aeiou", "tnsrh", "dlcmgp")
#: Single letters below, from rare to frequent (any order gives the same result).
LETTERS = "qxjzwkvfypbmcgdulhsrnoitae"
OTHER_GROUPS = 6
LEVELS = OTHER_GROUPS + len(LETTERS)
TRIE_WORDS = 20_000
QUERY_WORDS = 200_000
#: Searching words and candidate letters that a task handles at once.
BLOCK = 8192
CANDIDATES = 1 << 21
#: Top nodes that are sent to every task; more are joined by shuffle.
BROADCAST_NODES = 100_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


# ---- words ---------------------------------------------------------------

def word_runs(df: DataFrame, text: str = "text", letters: str = "[A-Za-zÀ-ÿ]", least: int = 1, carry: list[str] = ()) -> DataFrame:
    """``(*carry, run)``: the maximal runs of ``letters`` with at least ``least``
    of them in each whole text, A to Z lower-cased."""
    found = F.explode(F.regexp_extract_all(df[f"`{text}`"], F.lit(f"{letters}{{{least},}}"), 0))
    runs = df.select(*[df[f"`{c}`"] for c in carry], found.alias("run"))
    return runs.withColumn("run", F.translate("run", _UPPER, _UPPER.lower()))


def without_letter(run: Column, at: Column) -> Column:
    """``run`` without its code point ``at`` (from 0)."""
    return F.concat(F.substring(run, F.lit(1), at.cast("int")), F.substring(run, at.cast("int") + 2, F.length(run)))


def count_words(words: DataFrame, least: int = 2) -> DataFrame:
    """``(word, n)`` of the words that occur at least ``least`` times."""
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


# ---- top of the trie -----------------------------------------------------

def _of(word: Column, letters: str) -> Column:
    return F.length(word) - F.length(F.translate(word, letters, ""))


def routed(vocab: DataFrame) -> DataFrame:
    """``(node, kind, word, n)``: each word at its own top node (kind 0), and
    searching (1 at its own, 2 at others) at every node where it may find a pair:
    of the nodes of its length the later ones, and those one letter longer."""
    w = F.col("word")
    counts = [_of(w, letters).alias(f"c{i}") for i, letters in enumerate(TOP)]
    rows = vocab.select("word", "n", F.length("word").alias("size"), *counts)
    rows = rows.withColumn("c3", F.col("size") - F.col("c0") - F.col("c1") - F.col("c2"))

    def node(*steps: int) -> Column:
        return F.struct(*[(F.col(f"c{i}") + s).alias(f"c{i}") for i, s in enumerate(steps)])

    def entry(kind: int, steps) -> Column:
        here = F.struct(F.lit(kind).alias("kind"), node(*steps).alias("node"))
        gone = [i for i, s in enumerate(steps) if s < 0]
        return F.when(F.col(f"c{gone[0]}") > 0, here) if gone else here

    places = [entry(0, (0, 0, 0, 0)), entry(1, (0, 0, 0, 0))]
    for i in range(4):
        places.append(entry(2, [int(k == i) for k in range(4)]))
        for j in range(i + 1, 4):  # one more of an earlier group: a later node
            places.append(entry(2, [int(k == i) - int(k == j) for k in range(4)]))
    rows = rows.select("word", "n", F.explode(F.filter(F.array(*places), lambda x: x.isNotNull())).alias("x"))
    return rows.select("x.node", "x.kind", "word", "n")


def cells(routes: DataFrame, trie_words: int, query_words: int) -> DataFrame:
    """The routes dealt to cells ``(node, i, j)``: every searching word of a node
    meets every word of it in one cell."""
    sizes = routes.groupBy("node").agg(F.count(F.when(F.col("kind") == 0, 1)).alias("trie"), F.count(F.when(F.col("kind") > 0, 1)).alias("query"))
    sizes = written(sizes.filter("trie > 0").select(
        "node", F.ceil(F.col("trie") / trie_words).alias("across"), F.ceil(F.col("query") / query_words).alias("down")), "trie-nodes")
    small = sizes.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    rows = routes.join(F.broadcast(sizes) if small else sizes, "node")
    own = F.col("kind") == 0
    mine = F.pmod(F.xxhash64("word"), F.when(own, F.col("across")).otherwise(F.col("down")))
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.when(own, F.col("down")).otherwise(F.col("across")) - 1))
    rows = rows.select("node", "kind", "word", "n", own.alias("own"), mine.alias("mine"), each.alias("other"))
    return rows.select("node", F.when(F.col("own"), F.col("mine")).otherwise(F.col("other")).alias("i"),
                       F.when(F.col("own"), F.col("other")).otherwise(F.col("mine")).alias("j"), "kind", "word", "n")


# ---- one cell ------------------------------------------------------------

_GROUP = np.full(128, -1, np.int64)
_GROUP[[ord(c) for c in LETTERS]] = OTHER_GROUPS + np.arange(len(LETTERS))


def letter_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words end to end, and where each word begins."""
    begin = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=begin[1:])
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4"), begin


def vectors(words: list[str]) -> np.ndarray:
    """Letter-group counts, one row a word, in the order of the trie's levels."""
    flat, begin = letter_rows(words)
    group = np.where(flat < 128, _GROUP[np.minimum(flat, 127)], -1)
    group = np.where(group < 0, flat % OTHER_GROUPS, group)
    at = np.repeat(np.arange(len(words)), np.diff(begin))
    return np.bincount(at * LEVELS + group, minlength=len(words) * LEVELS).reshape(-1, LEVELS)


class Trie:
    """Words by their successive counts: per level the sorted keys ``(parent node,
    count)`` of its nodes, at the leaves runs of words."""

    def __init__(self, words: list[str], n: np.ndarray):
        order = sorted(range(len(words)), key=words.__getitem__)  # ties go to the smaller word
        self.words, self.n = [words[i] for i in order], n[order]
        v = vectors(self.words)
        by = np.lexsort(v.T[::-1])
        v = v[by]
        differs = np.ones(v.shape, bool)
        differs[1:] = np.logical_or.accumulate(v[1:] != v[:-1], axis=1)
        self.base = int(v.max(initial=0)) + 3
        self.levels, parent = [], np.zeros(len(v), np.int64)
        for g in range(LEVELS):
            first = differs[:, g]
            self.levels.append(parent[first] * self.base + v[first, g])
            parent = np.cumsum(first) - 1
        self.leaf_words = by
        self.leaf_at = np.append(np.flatnonzero(differs[:, -1]), len(v))

    def search(self, v: np.ndarray, deficit: bool):
        """``(row, leaf)`` of all leaves within one surplus and, if ``deficit``, one
        deficit of the vectors; branches beyond the budget are never entered."""
        row, node = np.arange(len(v)), np.zeros(len(v), np.int64)
        plus, minus = np.ones(len(v), bool), np.full(len(v), deficit)
        for g, keys in enumerate(self.levels):
            count = np.minimum(v[row, g], self.base - 2)
            tries = [(slice(None), count, 0), (np.flatnonzero(plus), None, 1), (np.flatnonzero(minus & (count > 0)), None, -1)]
            found = []
            for own, at, step in tries:
                at = count[own] + step if at is None else at
                want = node[own] * self.base + at
                where = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                hit = keys[where] == want
                found.append((row[own][hit], where[hit], plus[own][hit] & (step <= 0), minus[own][hit] & (step >= 0)))
            row, node, plus, minus = (np.concatenate(x) for x in zip(*found))
        return row, node


def letters_of(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points."""
    flat, begin = letter_rows(words)
    return flat.reshape(len(words), -1) if len(words) else flat.reshape(0, 0)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether row by row one edit makes ``b``, of the same length or one longer, of ``a``."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    left = np.logical_or.accumulate(a != b[:, :-1], axis=1).sum(axis=1)  # letters from the first unlike one on
    right = np.logical_or.accumulate((a != b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return left + right <= a.shape[1]


def meet(trie: Trie, shapes: np.ndarray, words: list[str], own: np.ndarray):
    """Pairs ``(searching word, trie word)`` one edit apart; a word of the trie's
    own node (``own``) meets later words only."""
    size = len(trie.words[0])
    by_size: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_size.setdefault(len(w), []).append(i)
    later = np.array([bisect_right(trie.words, w) if o else 0 for w, o in zip(words, own.tolist())], np.int64)
    for n, rows in by_size.items():
        rows = np.array(rows)
        some = [words[i] for i in rows]
        mine = letters_of(some)
        q, leaf = trie.search(vectors(some), deficit=n == size)
        many = trie.leaf_at[leaf + 1] - trie.leaf_at[leaf]
        ends, step, at = np.cumsum(many), max(1, CANDIDATES // size), 0
        while at < len(q):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + step, "right")))
            times = many[at:to]
            a = np.repeat(q[at:to], times)
            start = np.repeat(trie.leaf_at[leaf[at:to]] - (np.cumsum(times) - times), times)
            b = trie.leaf_words[start + np.arange(len(a))]
            ahead = b >= later[rows[a]]
            a, b = a[ahead], b[ahead]
            near = one_edit(mine[a], shapes[b])
            yield rows[a[near]], b[near]
            at = to


class Cell:
    """One cell's trie, and what its words have met so far."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.trie = Trie(words, n)
        self.shapes = letters_of(self.trie.words)
        self.near = np.zeros(len(words), np.int64)
        self.best: dict[int, tuple] = {}

    def ask(self, words: list[str], n: np.ndarray, own: np.ndarray):
        """Rows ``(word, near, -n of the best, best)`` of the searching words."""
        pairs = list(meet(self.trie, self.shapes, words, own))
        a, b = (np.concatenate(x) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        out = []
        for at, other, first in _best(a, b, self.trie.n, np.arange(len(self.trie.words))):
            out.append((words[at], other, -int(self.trie.n[first]), self.trie.words[first]))
        rank = np.empty(len(words), np.int64)
        rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        for at, other, first in _best(b, a, n, rank):
            self.near[at] += other
            found = (-int(n[first]), words[first])
            self.best[at] = min(self.best.get(at, found), found)
        return out

    def rows(self):
        return [(self.trie.words[i], int(self.near[i]), *best) for i, best in self.best.items()]


def _best(x: np.ndarray, y: np.ndarray, n: np.ndarray, rank: np.ndarray):
    """Of each ``x``: how many ``y`` it has, and the one of the largest ``n`` and least ``rank``."""
    order = np.lexsort((rank[y], -n[y], x))
    x, y = x[order], y[order]
    begin = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)
    return zip(x[begin].tolist(), np.diff(np.append(begin, len(x))).tolist(), y[begin].tolist())


_COLUMNS = ["word", "near", "minus_n", "best"]


def _batch(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 4
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], _COLUMNS)


def _search(batches):
    """Cells in order, each its trie's words first and then searching words
    (False: a cell without words of its own, in which nothing is found)."""
    key, cell = None, None
    words, n, own = [], [], []

    def ask(whole: bool):
        nonlocal words, n, own
        if words and cell is not None and (whole or len(words) >= BLOCK):
            rows = cell.ask(words, np.array(n, np.int64), np.array(own, bool)) if cell else []
            words, n, own = [], [], []
            yield from ([_batch(rows)] if rows else [])

    for batch in batches:
        node = batch.column("node")
        cols = [node.field(k).to_numpy() for k in range(4)] + [batch.column(k).to_numpy() for k in ("i", "j")]
        kind = batch.column("kind").to_numpy()
        table = np.stack(cols + [kind > 0])
        cut = [0, *(np.flatnonzero((table[:, 1:] != table[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cut[:-1], cut[1:]):
            if a == b:
                continue
            here = tuple(int(c[a]) for c in cols)
            if here != key:
                yield from ask(True)
                if cell and cell.best:
                    yield _batch(cell.rows())
                key, cell, words, n, own = here, None, [], [], []
            if kind[a] > 0 and cell is None:
                cell, words, n, own = Cell(words, np.array(n, np.int64)) if words else False, [], [], []
            words += batch.column("word").slice(a, b - a).to_pylist()
            n += batch.column("n").slice(a, b - a).to_pylist()
            own += (kind[a:b] == 1).tolist()
            yield from ask(False)
    yield from ask(True)
    if cell and cell.best:
        yield _batch(cell.rows())


# ---- forms ---------------------------------------------------------------

def near_words(vocab: DataFrame, trie_words: int = TRIE_WORDS, query_words: int = QUERY_WORDS) -> DataFrame:
    """``(word, near, minus_n, best)``: parts, one for each cell, of how many near words a word
    has and which of them is the most frequent."""
    ship(vocab.sparkSession)
    placed = cells(routed(vocab), trie_words, query_words)
    place = ["node", "i", "j"]
    placed = placed.repartition(*place).sortWithinPartitions(*place, "kind")
    return placed.mapInArrow(_search, "word string, near bigint, minus_n bigint, best string")


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the words in ``(word, form)``, by doubling the steps."""
    now = written(forms.select("word", F.col("form").alias("root")), "trie-roots")
    while True:
        after = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = written(now.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "trie-roots")
        if now.filter("moved").limit(1).count() == 0:
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(vocab: DataFrame, ratio: int = 10, trie_words: int = TRIE_WORDS, query_words: int = QUERY_WORDS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word in ``(word, n)``."""
    vocab = written(vocab.select("word", "n"), "trie-words")
    parts = near_words(vocab, trie_words, query_words)
    none = F.lit(None)
    rows = vocab.select("word", "n", F.lit(0).cast("bigint").alias("near"), none.cast("bigint").alias("minus_n"), none.cast("string").alias("best"))
    rows = rows.union(parts.select("word", none.cast("bigint"), "near", "minus_n", "best"))
    best = F.min(F.when(F.col("best").isNotNull(), F.struct("minus_n", "best"))).alias("best")
    rows = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), best)
    often = -F.col("best.minus_n") >= ratio * F.col("n")
    rows = written(rows.select("word", F.when(often, F.col("best.best")).alias("form"), "n", "n_near",
                               F.when(often, -F.col("best.minus_n")).alias("form_n")), "trie-forms")
    ends = roots(rows.filter("form is not null").select("word", "form"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
