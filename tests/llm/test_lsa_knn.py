"""Votes against plain cosine, and held-out accuracy."""

import numpy as np
import pyarrow as pa
import pytest

from tablekit.llm import lsa_knn as L
from tablekit.llm import textops
from tablekit.llm.runtime import utf8_bytes

SMOKE = "/root/testdata/sf0.1"


def hashes(*words):
    buf, offs = utf8_bytes(pa.array([" ".join(words)]))
    return textops.span_hashes(buf, *textops.word_spans(buf, offs)[:2])


def dense(x, width):
    out = np.zeros((len(x.first) - 1, width + L.LAYOUT))
    for i in range(len(out)):
        out[i, x.cols[x.first[i]:x.first[i + 1]]] = x.vals[x.first[i]:x.first[i + 1]]
    out[:, width:] = x.layout
    return out


def test_counts_of_terms(prose):
    a, b, empty = prose(30, 1), "the the cat | The", ""
    vocabulary = np.sort(hashes("the", "cat", "unseen"))
    got = dense(L.counts(pa.array([a, empty, b]), vocabulary), 4)
    assert got[1].sum() == 0
    assert got[0, :4].tolist() == [0, 0, 0, 30]
    place = {w: int(np.searchsorted(vocabulary, hashes(w)[0])) for w in ("the", "cat", "unseen")}
    assert got[2, place["the"]] == 3 and got[2, place["cat"]] == 1 and got[2, place["unseen"]] == 0 and got[2, 3] == 1
    assert got[0, 4:-L.MARKS].sum() == len(a.encode()) - 1
    assert got[2, -L.MARKS] == 8
    assert (got[2] == dense(L.counts(pa.array([b]), vocabulary), 4)[0]).all()
    assert dense(L.counts(pa.array([b, ""]), vocabulary[:0]), 1)[0, 0] == 5
    assert L.counts(pa.array(["", ""]), vocabulary).first.tolist() == [0, 0, 0]


def test_projection_by_plain_matrices(prose, monkeypatch):
    monkeypatch.setattr(L, "ENTRIES", 50)
    texts = pa.array([prose(5 + 9 * i, i) for i in range(30)] + ["", "ka " * 300, "?"])
    words = sorted({w for t in texts.to_pylist() for w in t.split()})[::2]
    vocabulary = np.unique(hashes(*words))
    width = len(vocabulary) + 1
    c = L.counts(texts, vocabulary)
    plain = np.log1p(dense(c, width))
    idf = (1 + np.random.default_rng(1).random(width + L.LAYOUT)).astype(np.float32)
    want = plain * idf
    for part in (slice(0, width), slice(width, None)):
        norm = np.linalg.norm(want[:, part], axis=1, keepdims=True)
        want[:, part] /= np.where(norm > 0, norm, 1)
    x = L.weighted(c, idf)
    assert dense(x, width) == pytest.approx(want, abs=1e-6)
    b = np.random.default_rng(2).normal(size=(width + L.LAYOUT, 7))
    assert L.times(x, b) == pytest.approx(want @ b, abs=1e-5)
    basis = L.leading(x, width, 6)
    _, sizes, vecs = np.linalg.svd(want, full_matrices=False)
    assert basis.T @ basis == pytest.approx(np.eye(6), abs=1e-4)
    assert np.linalg.norm(want @ basis, axis=0) == pytest.approx(sizes[:6], rel=1e-3)
    assert abs((vecs[:3] @ basis[:, :3]).diagonal()) == pytest.approx(np.ones(3), abs=1e-2)


def test_vocabulary_by_documents(spark, docs):
    texts = ["one Two two", "two three", "three one", "four four four", None]
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id bigint, quality int")
    model = L.learn(docs(texts), labels)
    assert set(model.vocabulary.tolist()) == set(hashes("one", "two", "three").tolist())
    twice = L.learn(docs(texts).union(docs(texts)), labels)
    assert (twice.vocabulary == model.vocabulary).all() and twice.vectors == pytest.approx(model.vectors, abs=1e-4)


def test_votes_by_plain_cosine():
    rnd = np.random.default_rng(2)
    vectors = L.unit(rnd.normal(size=(40, 5)).astype(np.float32))
    vectors[7] = vectors[3]  # a tie
    labels = rnd.integers(0, 2, 40).astype(float)
    m = L.Model(None, None, None, vectors, np.arange(40), labels, (0.5, 2.0), 0.8, neighbours=4)
    v = np.vstack([L.unit(rnd.normal(size=(2000, 5)).astype(np.float32)), vectors[:1], np.zeros((1, 5), np.float32)])
    ids = [-1] * 2000 + [0, -1]
    got = m.vote(v, ids)
    for i in (0, 1, 500, 1023, 1024, 1999, 2000):
        sims = [round(float(x), 5) if ids[i] != j else -1 for j, x in enumerate(v[i] @ vectors.T)]
        least = sorted(sims)[-4]
        yes = sum(s ** 4 * 2.0 for s, y in zip(sims, labels) if s >= least and s > 0 and y)
        no = sum(s ** 4 * 0.5 for s, y in zip(sims, labels) if s >= least and s > 0 and not y)
        assert got[i] == pytest.approx(yes / (yes + no), abs=1e-3)
    assert got[2001] == 0.8


def test_edge_rows(spark, docs, prose):
    texts = [prose(40, i) if i % 2 else "%% ".join(prose(40, i).split()) for i in range(80)] + [None, "", prose(3000, 5), prose(3000, 5), prose(300_000, 6)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(80, None), (None, 1)], "doc_id bigint, quality int")
    df = docs(texts, extra=True)
    model = L.learn(df, labels)
    got = {r["doc_id"]: r["score"] for r in L.score(df, model).collect()}
    assert len(got) == 85 and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.7) == bool(i % 2) for i in range(60, 80))
    assert got[80] == got[81] == pytest.approx(0.5) and got[82] == got[83]
    assert L.score(docs([]), model).count() == 0
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r["score"] for r in L.score(df, L.learn(df, none)).collect()} == {0.5}


def test_held_out_accuracy(spark):
    from tablekit.llm import QUERIES
    labels = spark.read.parquet(f"{SMOKE}/labels.parquet")
    got = QUERIES["op8_lsa_knn"](spark, SMOKE).join(labels, "doc_id").filter("held_out and quality is not null").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.99
