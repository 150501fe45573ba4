"""Spot signatures against plain Python, and fingerprints of whole tables."""

import random
import re
from hashlib import sha256

import pyarrow as pa
import pytest

from tablekit.llm import spotsigs as S

APART = re.compile("[\x20\x09-\x0d" + re.escape("".join(chr(c) for c in range(0x21, 0x80) if not chr(c).isalnum())) + "]+")
LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def spots(text, distance=1, chain=2):
    words = [w for w in APART.split((text or "").translate(LOWER)) if w]
    out = set()
    for i, w in enumerate(words):
        if w in S.ANCHORS:
            rest = [x for x in words[i + 1:] if x not in S.ANCHORS][::distance]
            if len(rest) >= chain:
                out.add((w, *rest[:chain]))
    return out or ({tuple(words)} if words else set())


def texts():
    rnd = random.Random(3)
    words = "the of and river stone der bridge für light la noche house, Green. that's it".split()
    out = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60))) for _ in range(80)]
    return out + [out[5], "", " .,! ", "single", "the", "the end", "the very end", "É é the É é", "x" * 3000]


@pytest.mark.parametrize("distance, chain", [(1, 2), (2, 3), (3, 1)])
def test_signatures(distance, chain):
    rows = texts()
    got = S.signatures(pa.array(rows), distance, chain)
    want = [spots(t, distance, chain) for t in rows]
    for i in range(len(rows)):
        assert len(got[i]) == len(want[i]), rows[i]
        for j in (i // 2, (i * 7) % len(rows)):
            a, b = want[i], want[j]
            assert S.jaccard(got[i], got[j]) == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)


def test_pruned_comparison_and_partitions():
    rows = S.signatures(pa.array(texts()))
    for a in rows:
        for b in rows[::5]:
            full = S.jaccard(a, b)
            assert S.jaccard(a, b, 0.6, step=4) == (full if full >= 0.6 else 0.0)
            if full >= S.PARTITION:
                assert abs(S.length_partition(len(a)) - S.length_partition(len(b))) <= 1


def test_fingerprints_of_a_table(spark, docs):
    rows = texts() + [None]
    got = {r["doc_id"]: r for r in S.fingerprints(docs(rows, extra=True)).collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(rows):
        t, following = t or "", rows[(i + 1) % len(rows)] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        r, a = got[i], spots(t)
        assert r["n_chars"] == len(t) and r["edited_sha256"] == sha256(edited.encode()).hexdigest()
        for name, b in (("near_edited", spots(edited)), ("near_next", spots(following))):
            assert r[name] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert (got[5]["fingerprint"] == r["fingerprint"]) == (a == spots(rows[5]))
        assert (r["edited_fingerprint"] == r["fingerprint"]) == (a == spots(edited))


def test_edge_tables(spark, docs):
    assert S.fingerprints(docs([])).count() == 0
    alone = S.fingerprints(docs(["the one and only text"])).first()
    assert alone["near_next"] == 1.0 and alone["edited_sha256"] == sha256(b"the one andthe one an").hexdigest()
    ties = docs(["b", "c"]).union(docs(["a"]))  # two rows of id 0: by text
    got = [r["edited_sha256"] for r in S.fingerprints(ties).orderBy("doc_id", "n_chars").collect()]
    assert len(got) == 3
    null = spark.createDataFrame([(None, "the null id comes first"), (2, "of two rows")], "doc_id bigint, text string")
    assert S.fingerprints(null).count() == 2


def test_likeness_from_the_strings(spark, docs):
    rows = S.fingerprints(docs(texts() + [None])).collect()
    for r in rows:
        assert S.likeness(r["fingerprint"], r["edited_fingerprint"]) == r["near_edited"]
    by_id = sorted(rows, key=lambda r: r["doc_id"])
    for r, following in zip(by_id, by_id[1:]):
        assert S.likeness(r["fingerprint"], following["fingerprint"]) == r["near_next"]
        assert (S.signature_set(r["fingerprint"]) == S.signatures(pa.array([(texts() + [None])[r["doc_id"]] or ""]))[0]).all()


def reach(n, links):
    name = list(range(n))
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(name[i], name[j])
            changed |= name[i] != low or name[j] != low
            name[i] = name[j] = low
    return name


@pytest.mark.parametrize("least", [0.8, 0.9])
def test_near_copies_against_every_pair(spark, docs, least):
    rnd = random.Random(8)
    names = [f"word{i}" for i in range(300)]
    base = [" ".join(rnd.choice(["the", "of", "und", "la"]) + " " + " ".join(rnd.sample(names, 3)) for _ in range(rnd.randint(1, 60))) for _ in range(40)]
    rows = list(base)
    for b in base:
        for share in (0.02, 0.05, 0.1, 0.15, 0.3):
            words = b.split()
            for _ in range(max(1, int(share * len(words) / 4))):
                words[rnd.randrange(len(words))] = rnd.choice(names)
            rows.append(" ".join(words) + (" the very new ending" if rnd.random() < 0.3 else ""))
    # a group of many near copies, and of equal ones
    rows += [base[0] + f" the tail{i} here" for i in range(80)] + [base[1]] * 20 + ["", None, "!?"]
    sets = [spots(t) for t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i)
             if (len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]) - 1e-9 if sets[i] | sets[j] else True)]
    got = {r["doc_id"]: r["class_id"] for r in S.near_copies(S.fingerprints(docs(rows)), least=least).collect()}
    assert [got[i] for i in range(len(rows))] == reach(len(rows), links)
    assert S.near_copies(S.fingerprints(docs([]))).count() == 0
