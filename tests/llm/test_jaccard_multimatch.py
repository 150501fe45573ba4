"""Links and components against every pair."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tablekit.llm import jaccard_multimatch as J
from tablekit.llm.components import components

WS = " \t\n\x0b\x0c\r"
LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def shingles(text):
    words, word = [], ""
    for c in (text or "").translate(LOWER) + " ":
        if c in WS:
            words += [word] if word else []
            word = ""
        else:
            word += c
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 3]) for i in range(len(words) - 2)}


def reach(n, links):
    name = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(name[a], name[b])
            changed |= name[a] != m or name[b] != m
            name[a] = name[b] = m
    return name


def brute(texts):
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])]
    return [(len(s), c) for s, c in zip(sets, reach(len(sets), links))]


def edited(words, rnd, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = "new%d" % rnd.randrange(10 ** 9)
    return " ".join(words)


def corpus():
    rnd = random.Random(7)
    vocabulary = ["w%d" % i for i in range(300)]
    texts = [None, "", " \n", "a", "A", "a b", "a  b", "a b c", "A B c", "x y z q", "é É"]
    line = " ".join("common%d" % i for i in range(12))
    for g in range(12):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([8, 25, 60, 150]))]
        texts += [" ".join(base)] * rnd.randint(1, 4)
        texts += [edited(base, rnd, rnd.randint(1, 4)) for _ in range(rnd.choice([2, 5, 25]))]
        texts.append(line + "\n" + " ".join(base[: len(base) // 2]))
    chain = [rnd.choice(vocabulary) for _ in range(200)]
    for _ in range(15):  # each near the one before, the ends far apart
        texts.append(" ".join(chain))
        chain[rnd.randrange(200)] = "step%d" % rnd.randrange(10 ** 9)
    rnd.shuffle(texts)
    return texts


def test_components_match_every_pair(spark, docs):
    texts = corpus()
    out = J.linked(docs(texts, extra=True))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_empty_table_and_repeated_ids(spark, docs):
    assert J.linked(docs([])).count() == 0
    twice = docs(["a b c d", "e f g h"]).union(docs(["a b c d", "x y z"], start=1))
    assert sorted(tuple(r) for r in J.linked(twice).collect()) == [(0, 2, 0), (1, 2, 0), (1, 2, 1), (2, 1, 2)]


def test_null_id(spark, docs):
    rows = spark.createDataFrame([(None, "a b c"), (3, "a b c"), (None, "q r s t")], "doc_id bigint, text string")
    got = sorted(J.linked(rows).collect(), key=str)
    assert [r["component_id"] for r in got if r["doc_id"] == 3] == [3] and len(got) == 3


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1), st.sets(st.integers(0, 60), min_size=1), st.integers(1, 4))
def test_l_prefixes_of_linked_sets_share_l_tokens(a, b, l):
    if 100 * len(a & b) < 90 * len(a | b):
        return
    need = -(-9 * (len(a) + len(b)) // 19)
    l = min(l, need)
    heads = [set(sorted(s)[:len(s) - need + l]) for s in (a, b)]
    assert len(heads[0] & heads[1]) >= l
    assert all(len(s) - need + l <= len(s) - J.least_overlap(len(s)) + J.MOST for s in (a, b))


def test_components_of_a_long_path(spark):
    n = 60
    order = list(range(n))
    random.Random(2).shuffle(order)
    links = [(order[i], order[i + 1]) for i in range(n - 1)] + [(100, 101), (101, 100), (7, 7)]
    got = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{v: 0 for v in range(n)}, 100: 100, 101: 100}
