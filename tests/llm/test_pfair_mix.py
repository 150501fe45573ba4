"""The schedule against the ideal mix, and the documents against the schedule."""

import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tablekit.llm import pfair_mix as P


def ideal(blocks, weights, slots):
    """Each source's share of the first ``slots`` slots when all run at once."""
    left, done, t = [Fraction(b) for b in blocks], [Fraction(0)] * len(blocks), Fraction(slots)
    while t > 0 and any(left):
        live = [i for i, x in enumerate(left) if x > 0]
        total = sum(weights[i] for i in live)
        step = min(t, min(left[i] * total / weights[i] for i in live))
        for i in live:
            done[i] += step * weights[i] / total
            left[i] -= step * weights[i] / total
        t -= step
    return done


@pytest.mark.parametrize("seed", range(8))
def test_less_than_one_block_off_at_any_slot(seed):
    rnd = random.Random(seed)
    k = rnd.randint(1, 12)
    blocks = [rnd.choice([1, 2, 7, 40, 90]) for _ in range(k)]
    weights = [rnd.choice([0.01, 0.3, 1.0, 2.5, 1 / 3, 7.77]) for _ in range(k)]
    source, block, slot = P.schedule(blocks, weights)
    assert sorted(slot.tolist()) == list(range(sum(blocks)))
    whole = [Fraction(w) for w in P.whole_weights(weights)]
    for w, x in zip(whole, weights):
        assert abs(w / sum(whole) - Fraction(x) / Fraction(sum(weights))) < Fraction(1, 1 << 30)
    at = sorted(zip(slot.tolist(), source.tolist(), block.tolist()))
    done = [0] * k
    for t, (_, i, j) in enumerate(at, 1):
        assert j == done[i]
        done[i] += 1
        assert all(abs(d - x) < 1 for d, x in zip(done, ideal(blocks, whole, t)))
    assert done == blocks


def test_a_thousand_sources_of_any_weight():
    rnd = np.random.default_rng(2)
    blocks = np.append(rnd.integers(1, 60, 999), 20_000)
    weights = np.append(rnd.random(999) ** 4 + 1e-4, 40.0)
    source, block, slot = P.schedule(blocks.tolist(), weights.tolist())
    whole = np.array(P.whole_weights(weights.tolist()), float)
    order = np.argsort(slot)
    assert (slot[order] == np.arange(blocks.sum())).all()
    source = source[order]
    end = np.sort(blocks / whole)
    for t in range(37, len(source), 997):
        done = np.bincount(source[:t], minlength=1000)
        lo, hi = 0.0, end[-1]
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if np.minimum(whole * mid, blocks).sum() < t else (lo, mid)
        assert np.abs(done - np.minimum(whole * lo, blocks)).max() < 1 + 1e-6


def test_blocks_run_between_release_and_deadline():
    blocks, weights = np.array([50, 7, 1, 23], np.int64), np.array([3, 1, 5, 2], np.int64)
    source, block, release, due = P.windows(blocks, weights)
    slot = P.earliest_deadline_first(release, due)
    assert (release <= slot).all() and (slot < due).all()


def collected(df):
    return [r.asDict(True) for r in df.collect()]


def test_documents_follow_the_schedule(spark, docs):
    rnd = random.Random(9)
    texts = ["x" * rnd.randint(0, 300) for _ in range(400)] + [None, "", "y" * 5000]
    sources = [rnd.choice(["a", "a", "a", "b", "c", None]) for _ in texts]
    df = docs(texts, extra=True, sources=sources)
    got = collected(P.mixed(df, block_chars=500))
    assert sorted(r["row"]["doc_id"] for r in got) == list(range(len(texts)))
    assert all(set(r["row"]) == set(df.columns) for r in got)
    streams = defaultdict(list)
    for r in got:
        streams[r["row"]["source"]].append(r)
    chars = {}
    for s, rows in streams.items():  # documents of a source end to end, blocks by where they begin
        assert len({r["stream"] for r in rows}) == 1
        rows.sort(key=lambda r: (r["order"] % (1 << 64) >> 52, r["order"], r["tie"] or 0))
        at = 0
        for r in rows:
            assert r["size"] == len(r["row"]["text"] or "") + 1 and (r["block"], r["offset"]) == divmod(at, 500)
            at += r["size"]
        chars[s] = at
    names = sorted(chars, key=lambda s: (-chars[s], s is not None, s or ""))
    source, block, slot = P.schedule([-(-chars[s] // 500) for s in names], [chars[s] ** 0.7 for s in names])
    want = {(names[i], j): t for i, j, t in zip(source.tolist(), block.tolist(), slot.tolist())}
    assert all(r["slot"] == want[r["row"]["source"], r["block"]] for r in got)
    ordered = [r["row"]["doc_id"] for r in P.in_order(P.mixed(df, block_chars=500)).collect()]
    assert ordered == [r["row"]["doc_id"] for r in sorted(got, key=lambda r: (r["slot"], r["offset"], r["order"], r["tie"] or 0))]


def test_the_order_does_not_depend_on_the_number_of_partitions(spark, docs, prose):
    df = docs([prose(i % 60, i) for i in range(200)], sources=["s%d" % (i % 7) for i in range(200)])
    before, orders = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (3, 8, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            orders.append([r["row"]["doc_id"] for r in P.in_order(P.mixed(df.repartition(n), block_chars=300)).collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert orders[0] == orders[1] == orders[2] and sorted(orders[0]) == list(range(200))


def test_many_sources_keep_their_own_weights(spark, docs):
    n = 400
    texts, sources = ["abc" * 20] * (3 * n), ["s%03d" % (i % n) for i in range(3 * n)]
    weights = {f"s{i:03d}": 10.0 if i == 399 else 1.0 for i in range(n)}
    got = collected(P.mixed(docs(texts, sources=sources), block_chars=61, weights=weights))
    assert len({r["stream"] for r in got}) == n and sorted(r["row"]["doc_id"] for r in got) == list(range(3 * n))
    heavy = sorted(r["slot"] for r in got if r["row"]["source"] == "s399")
    assert heavy[2] < 3 * (n + 9) / 10 + 1  # three blocks at ten times the weight


def test_left_out_sources_come_last_and_empty_table(spark, docs):
    texts, sources = ["abc" * 50] * 90, ["s%d" % (i % 9) for i in range(90)]
    got = collected(P.mixed(docs(texts, sources=sources), block_chars=200, weights={"s0": 0.5, "s1": 0.25, "s8": 0.25}))
    assert len({r["row"]["doc_id"] for r in got}) == 90
    named = [r["slot"] for r in got if r["row"]["source"] in ("s0", "s1", "s8")]
    assert max(named) < 8 + min(r["slot"] for r in got if r["row"]["source"] == "s5" and r["block"] > 0)
    assert P.mixed(docs([])).count() == 0
    twice = docs(["a", "b"]).union(docs(["a", "b"]))
    assert P.mixed(twice).count() == 4
    nothing = docs([None, "", None] * 50, sources=[None] * 150)
    assert P.mixed(nothing, block_chars=10).agg({"block": "max"}).first()[0] == 14


def test_schedule_of_a_large_corpus_stays_bounded(spark, monkeypatch, docs):
    monkeypatch.setattr(P, "BLOCKS", 20)
    got = collected(P.mixed(docs(["x" * 99] * 100, sources=["a", "b"] * 50), block_chars=10))
    assert max(r["slot"] for r in got) < 22 and len(got) == 100


@pytest.mark.parametrize("ranges", [1, 7, 60])
def test_rows_in_order_is_the_same_order(spark, docs, prose, ranges):
    rnd = random.Random(ranges)
    texts = [prose(rnd.randint(0, 60), i) for i in range(300)] + [None, "", "y" * 5000]
    df = docs(texts, extra=True, sources=[rnd.choice(["a", "a", "a", "b", "c", None]) for _ in texts])
    df = df.union(df.filter("doc_id % 3 = 0")).union(df.filter("doc_id % 30 = 0"))
    want = [r["row"] for r in P.in_order(P.mixed(df, block_chars=300)).collect()]
    got = [r["row"] for r in P.rows_in_order(df.repartition(5), block_chars=300, ranges=ranges).collect()]
    assert len(got) == df.count() and got == want


def test_rows_in_order_of_repeated_rows_many_sources_and_empty_table(spark, docs, monkeypatch):
    df = docs(["abc" * 20] * 40, sources=["s%d" % (i % 13) for i in range(40)])
    df = df.withColumn("doc_id", df["doc_id"] % 2)  # a row stands up to four times in its source, other columns differ
    want = [r["row"] for r in P.in_order(P.mixed(df, block_chars=61)).collect()]
    for most in (1 << 20, 3):  # beyond the bound of what is sent to every task
        monkeypatch.setattr(P, "BROADCAST_ROWS", most)
        got = [r["row"] for r in P.rows_in_order(df, block_chars=61, ranges=9).collect()]
        assert [(r["doc_id"], r["source"]) for r in got] == [(r["doc_id"], r["source"]) for r in want]
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert P.rows_in_order(docs([])).count() == 0


def test_whole_rows_are_shuffled_once(spark, docs, prose):
    df = docs([prose(i % 60, i) for i in range(100)], sources=["s%d" % (i % 7) for i in range(100)])
    plan = P.rows_in_order(df)._jdf.queryExecution().executedPlan().toString()
    found = [x for x in plan.split("\n") if " Exchange " in x and "SinglePartition" not in x]  # scalar subqueries aside
    assert len(found) == 1 and "rangepartitioning(range" in found[0], plan
