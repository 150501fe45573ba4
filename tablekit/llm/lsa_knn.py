"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text's terms are its words, the pairs of neighbouring character classes, and
marks of repetition. The words are those that at least ``LEAST_DOCS`` documents
of the labelled sample have, the ``MOST_WORDS`` of the most documents; all
others count as one term. Counts are damped, weighted by inverse document
frequency and projected on the leading singular vectors of the sample's sparse
matrix. Every document's vector is compared with all labelled vectors
by exact cosine products in blocks, and its ``neighbours`` nearest (with all
that tie with the last) vote with weights by similarity, each class weighted
to its share among all labels.

The sample has at most ``PER_CLASS`` documents of each label, those of the
smallest hash of the id; the broadcast vectors are bounded by it. A text that
is itself in the sample doesn't vote for itself.

Null and empty texts have the zero vector, and score the share of label 1 among
the labels; so does every text if there are no labels at all (then 0.5). Null labels are
not learnt from. Repeated rows repeat their result; an empty table gives an
empty one; extra columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .runtime import ship, slices, utf8_bytes, written

PER_CLASS = 2000
#: Words of the vocabulary (a bound on what is broadcast), and documents of the sample that a word needs.
MOST_WORDS, LEAST_DOCS = 8192, 2
DIMS, NEIGHBOURS = 64, 15
BLOCK = 1024
#: Entries of a sparse matrix that are multiplied at once.
ENTRIES = 1 << 16


def _classes() -> np.ndarray:
    """Character class of each byte: letters by case, digits, spaces, line
    feeds, and the ASCII punctuation apart."""
    out = np.full(256, 1, np.int64)  # lower-case letters, and bytes of other letters
    out[65:91] = 2
    out[48:58] = 3
    out[[9, 11, 12, 13, 32]] = 4
    out[10] = 5
    for i, c in enumerate("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"):
        out[ord(c)] = 6 + min(i % 18, 17)
    return out


_CLASS = _classes()
CLASSES = 24
MARKS = 4
LAYOUT = CLASSES * CLASSES + MARKS


@dataclass
class Terms:
    """Term counts of texts: words as the rows' entries (``first`` is where each
    row's begin), layout terms as a plain matrix."""
    first: np.ndarray
    cols: np.ndarray
    vals: np.ndarray
    layout: np.ndarray


def counts(texts: pa.Array, vocabulary: np.ndarray) -> Terms:
    """Term counts, a row for each text. Word ``i`` is the one whose hash stands
    at ``i`` of the sorted vocabulary, the last column all other words."""
    buf, offs = utf8_bytes(texts)
    n = len(offs) - 1
    layout = np.zeros((n, LAYOUT), np.float32)
    if not len(buf):
        return Terms(np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32), layout)
    s, e, first = textops.word_spans(buf, offs)
    h = textops.span_hashes(textops.lower_ascii(buf), s, e)
    text = np.repeat(np.arange(n), np.diff(first))
    width = len(vocabulary) + 1
    at = np.searchsorted(vocabulary, h)
    if len(vocabulary):
        at[vocabulary[np.minimum(at, len(vocabulary) - 1)] != h] = len(vocabulary)
    keys, times = np.unique(text * width + at, return_counts=True)
    kind = _CLASS[buf]
    of = np.repeat(np.arange(n), np.diff(offs))
    same = of[1:] == of[:-1]
    pairs = (of[:-1] * CLASSES + kind[:-1]) * CLASSES + kind[1:]
    layout[:, :-MARKS] = np.bincount(pairs[same], minlength=n * CLASSES ** 2).reshape(n, -1)
    if len(h) > 1:
        twin = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
        layout[:, -MARKS] = 8 * np.bincount(text[1:][twin], minlength=n)
        step = np.zeros(len(h), bool)
        step[2:] = (h[2:] == h[:-2]) & (text[2:] == text[:-2])
        layout[:, -MARKS + 1] = 4 * np.bincount(text[step], minlength=n)
    return Terms(np.searchsorted(keys, np.arange(n + 1) * width), keys % width, times.astype(np.float32), layout)


def weighted(c: Terms, idf: np.ndarray) -> Terms:
    """Log counts times ``idf``, each family of terms brought to unit length."""
    words = len(idf) - LAYOUT
    vals, layout = np.log1p(c.vals) * idf[:words][c.cols], unit(np.log1p(c.layout) * idf[words:])
    n = len(c.first) - 1
    row = np.repeat(np.arange(n), np.diff(c.first))
    norm = np.sqrt(np.bincount(row, vals.astype(np.float64) ** 2, minlength=n))
    return Terms(c.first, c.cols, (vals / norm[row]).astype(np.float32), layout)


def times(x: Terms, b: np.ndarray) -> np.ndarray:
    """The product of the rows and a matrix, by runs of rows with few entries."""
    words = len(b) - x.layout.shape[1]
    out = x.layout @ b[words:]
    n, a = len(x.first) - 1, 0
    while a < n:
        to = max(a + 1, int(np.searchsorted(x.first, x.first[a] + ENTRIES, "right")) - 1)
        lo, hi = x.first[a], x.first[to]
        some = np.flatnonzero(np.diff(x.first[a:to + 1]))
        if len(some):
            part = x.vals[lo:hi, None] * b[x.cols[lo:hi]]
            out[a + some] += np.add.reduceat(part, x.first[a + some] - lo, axis=0)
        a = to
    return out


def turned(x: Terms, width: int) -> Terms:
    """The words' part of the matrix with rows and columns exchanged (no layout)."""
    row = np.repeat(np.arange(len(x.first) - 1), np.diff(x.first))
    order = np.argsort(x.cols, kind="stable")
    first = np.searchsorted(x.cols[order], np.arange(width + 1))
    return Terms(first, row[order], x.vals[order], np.zeros((width, 0), np.float32))


def leading(x: Terms, width: int, dims: int, rounds: int = 8) -> np.ndarray:
    """The leading right singular vectors (columns) by subspace iteration from a
    fixed start."""
    back = turned(x, width)
    q = np.random.default_rng(7).normal(size=(width + LAYOUT, dims + 16)).astype(np.float32)
    for _ in range(rounds):
        y = np.linalg.qr(times(x, q))[0]
        q = np.linalg.qr(np.vstack([times(back, y), x.layout.T @ y]))[0]
    _, _, turn = np.linalg.svd(times(x, q), full_matrices=False)
    return (q @ turn.T)[:, :dims].astype(np.float32)


@dataclass
class Model:
    vocabulary: np.ndarray
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    share: tuple  # weights of label 0 and label 1
    rate: float
    neighbours: int = NEIGHBOURS

    def project(self, texts: pa.Array) -> np.ndarray:
        return unit(times(weighted(counts(texts, self.vocabulary), self.idf), self.basis))

    def vote(self, v: np.ndarray, ids: list) -> np.ndarray:
        """Scores of unit vectors; a document doesn't vote for itself."""
        out = np.full(len(v), self.rate)
        if not len(self.vectors):
            return out
        own = {k: i for i, k in enumerate(self.ids.tolist())}
        for a in range(0, len(v), BLOCK):
            sims = np.round(v[a:a + BLOCK] @ self.vectors.T, 5)
            for i, k in enumerate(ids[a:a + BLOCK]):
                if k in own:
                    sims[i, own[k]] = -1.0
            k = min(self.neighbours, sims.shape[1])
            least = -np.partition(-sims, k - 1, axis=1)[:, k - 1:k]
            w = np.where((sims >= least) & (sims > 0), sims, 0.0).astype(np.float64) ** 4
            yes = w @ (self.labels * self.share[1])
            no = w @ ((1 - self.labels) * self.share[0])
            known = (yes + no > 0) & np.any(v[a:a + BLOCK] != 0, axis=1)
            out[a:a + BLOCK][known] = (yes / np.where(yes + no > 0, yes + no, 1))[known]
        return out


def unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n > 0, n, 1)


def _plain(text: pa.Array) -> pa.Array:
    return text.fill_null("") if text.null_count else text


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit the projection and the labelled vectors on the bounded sample."""
    ship(docs.sparkSession)
    known = labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")).filter("id is not null and y in (0, 1)")
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    order = F.xxhash64("id")
    some = [known.filter(F.col("y") == y).orderBy(order, "id").limit(PER_CLASS) for y in (0, 1)]
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(some[0].union(some[1])), "id")
    # repeated rows of an id count once
    rows = written(rows.groupBy("id").agg(F.first("y").alias("y"), F.min("text").alias("text")), "lsa-sample")
    kind = rows.schema["id"].dataType.simpleString()

    def words(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                buf, offs = utf8_bytes(_plain(part.column("text")))
                s, e, first = textops.word_spans(buf, offs)
                h = textops.span_hashes(textops.lower_ascii(buf), s, e)
                own = [np.unique(h[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own).view(np.int64), pa.int64())], ["h"])

    often = rows.select("text").mapInArrow(words, "h bigint").groupBy("h").agg(F.count("*").alias("docs")).filter(F.col("docs") >= LEAST_DOCS)
    often = often.orderBy(F.col("docs").desc(), "h").limit(MOST_WORDS).select("h").collect()
    vocabulary = np.sort(np.array([r["h"] for r in often], np.int64).view(np.uint64))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                c = counts(_plain(part.column("text")), vocabulary)
                cuts = list(zip(c.first[:-1].tolist(), c.first[1:].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("y").cast(pa.int32()),
                     pa.array([c.cols[a:b].astype(np.uint16).tobytes() for a, b in cuts], pa.binary()),
                     pa.array([c.vals[a:b].tobytes() for a, b in cuts], pa.binary()),
                     pa.array([r.tobytes() for r in c.layout], pa.binary())], ["id", "y", "cols", "vals", "layout"])

    got = rows.select("id", "text", "y").mapInArrow(run, f"id {kind}, y int, cols binary, vals binary, layout binary").orderBy("id").collect()
    rate = known.agg(F.avg("y")).first()[0]
    width = len(vocabulary) + 1
    if not got:
        none = np.zeros(0)
        return Model(vocabulary, np.ones(width + LAYOUT, np.float32), np.zeros((width + LAYOUT, 1), np.float32),
                     np.zeros((0, 1)), none, none, (1, 1), 0.5 if rate is None else float(rate))
    cols = [np.frombuffer(r["cols"], np.uint16) for r in got]
    c = Terms(np.cumsum([0] + [len(x) for x in cols]), np.concatenate(cols).astype(np.int64),
              np.concatenate([np.frombuffer(r["vals"], np.float32) for r in got]),
              np.array([np.frombuffer(r["layout"], np.float32) for r in got]))
    y = np.array([r["y"] for r in got], float)
    docs_with = np.concatenate([np.bincount(c.cols, minlength=width), (c.layout > 0).sum(axis=0)])
    idf = (np.log((1 + len(got)) / (1 + docs_with)) + 1).astype(np.float32)
    x = weighted(c, idf)
    basis = leading(x, width, min(DIMS, len(got)))
    share = ((1 - rate) / max(1e-9, 1 - y.mean()), rate / max(1e-9, y.mean()))
    return Model(vocabulary, idf, basis, unit(times(x, basis)), np.array([r["id"] for r in got]), y, share, float(rate))


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, score)`` of every row."""
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    src = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                v = shared.value.project(_plain(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(shared.value.vote(v, part.column("key").to_pylist()), pa.float64())], ["key", "score"])

    return src.mapInArrow(run, f"key {src.schema['key'].dataType.simpleString()}, score double").withColumnRenamed("key", key)
