"""Spelling variants against every pair of words, and the query against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablekit.llm import queries
from tablekit.llm import spelling_trie as T

SMOKE = "/root/testdata/sf0.001"


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n, ratio=10):
    by_size = {}
    for w in n:
        by_size.setdefault(len(w), []).append(w)
    out = {}
    for w in n:
        near = [x for k in (-1, 0, 1) for x in by_size.get(len(w) + k, ()) if one_apart(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form = best if best is not None and n[best] >= ratio * n[w] else None
        out[w] = [form, None, n[w], len(near), n[form] if form else None]
    for w, r in out.items():
        at = w
        while out[at][0]:
            at = out[at][0]
        r[1] = at
    return {w: tuple(r) for w, r in out.items()}


def rows(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def vocabulary(seed, size, letters="abcdeqé÷", lengths=(1, 2, 5, 7, 8, 9, 12)):
    rnd, n = random.Random(seed), {}
    while len(n) < size:
        w = "".join(rnd.choice(letters) for _ in range(rnd.choice(lengths)))
        n[w] = rnd.choice((2, 3, 20, 30, 400, 5000))
        for _ in range(2):
            at, c = rnd.randrange(len(w) + 1), rnd.choice(letters)
            n.setdefault(rnd.choice((w[:at] + c + w[at:], w[:at] + c + w[at + 1:], w[:at] + w[at + 1:])) or "a", rnd.choice((2, 3, 25)))
    return n


@pytest.mark.parametrize("trie_words, query_words", [(20_000, 200_000), (7, 11)])
def test_against_every_pair(spark, trie_words, query_words):
    n = vocabulary(5, 500) | {"x" * 3000: 40, "x" * 2999 + "y": 4, "x" * 3001: 3, "日本語": 50, "日本吾": 5, "𝒳𝒴": 2, "𝒳𝒵": 2}
    df = spark.createDataFrame(list(n.items()), "word string, n bigint").withColumn("form", F.lit("x")).withColumn("near", F.lit(1))
    assert rows(T.variants(df, trie_words=trie_words, query_words=query_words)) == brute(n)


def test_one_hot_node_in_many_cells(spark):
    # words of the same letters: one top node, one vector
    rnd = random.Random(2)
    letters = list("abcdefghij")
    n = {}
    while len(n) < 400:
        rnd.shuffle(letters)
        n["".join(letters)] = 2
    n |= {w[:-1] + "z": 30 for w in list(n)[:50]}
    df = spark.createDataFrame(list(n.items()), "word string, n bigint")
    assert T.cells(T.routed(df), 40, 60).filter("kind = 0").select("node", "i").distinct().count() > 10
    assert rows(T.variants(df, trie_words=40, query_words=60)) == brute(n)


def test_long_chains_of_forms(spark):
    n = {"abcdefgh"[:7] + "x" * i: 2 * 10 ** i for i in range(9)}
    got = rows(T.variants(spark.createDataFrame(list(n.items()), "word string, n bigint")))
    assert got == brute(n)
    assert {r[1] for r in got.values()} == {"abcdefg" + "x" * 8}


def test_ties_go_to_the_smaller_word(spark):
    n = {"aaaaaab": 50, "aaaaaac": 50, "aaaaaad": 5, "aaaaaa": 50}
    assert rows(T.variants(spark.createDataFrame(list(n.items()), "word string, n bigint")))["aaaaaad"][0] == "aaaaaa"


def test_search_never_leaves_the_budget():
    words = sorted(vocabulary(9, 300, lengths=(8,)))
    words = [w for w in words if len(w) == 8]
    trie = T.Trie(words, np.ones(len(words), np.int64))
    v = T.vectors(words)
    row, leaf = trie.search(v, deficit=True)
    first = trie.leaf_words[trie.leaf_at[leaf]]
    step = v[first] - v[row]
    assert (np.abs(step).sum(axis=1) <= 2).all() and (step.max(axis=1) <= 1).all() and (step.min(axis=1) >= -1).all()


def plain_vocabulary(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 2}


def test_query_on_whole_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()]
    n = plain_vocabulary(docs)
    assert len(n) > 300
    assert rows(queries.op11_frequency_vector_trie(spark, SMOKE)) == brute(n)


def test_nulls_repeats_and_long_texts(spark, tmp_path):
    texts = ["Recieved received receiver", None, "", "ÀÉÎõü÷× Straßenbahn straßenbahn", "word " * 20_000 + "pneumonia " * 30,
             "pneumonja pneumonja received RECEIVED recEIved", "x" * 70_000 + " " + "x" * 70_000, "1234567 ___ ab"] * 2
    df = spark.createDataFrame([(None if i == 5 else i // 2, t, i) for i, t in enumerate(texts)], "doc_id bigint, text string, word int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert rows(queries.op11_frequency_vector_trie(spark, str(tmp_path))) == brute(plain_vocabulary([(r[0], r[1]) for r in df.collect()]))
    none = spark.createDataFrame([], "word string, n bigint")
    assert T.variants(none).count() == 0
