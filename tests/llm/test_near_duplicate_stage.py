"""The pipeline's near-duplicate stage against every pair by five words and 0.8."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as C  # noqa: E402
from tablekit.llm import jaccard_multimatch as J, runtime  # noqa: E402

from test_jaccard_multimatch import reach  # noqa: E402


def grams(text, k):
    words = (text or "").lower().split()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def brute(texts, k, percent):
    sets = [grams(t, k) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return [(len(s), c) for s, c in zip(sets, reach(len(sets), links))]


@pytest.fixture(scope="module")
def texts(prose):
    rnd = random.Random(3)
    out = [None, "", "one", "one two three four", "one two three four five"]
    for i in range(40):
        words = prose(rnd.randint(4, 250), i).split()
        out.append(" ".join(words))
        for share in (0.05, 0.12, 0.2, 0.24, 0.3):  # texts with that share appended
            out.append(" ".join(words + prose(int(share * len(words)) + 1, 1000 + i).split()))
        for edits in (1, 4, 7, 12):  # isolated edits
            other = list(words)
            for at in range(3, len(other), max(6, len(other) // edits)):
                other[at] = "edit%d" % at
            out.append(" ".join(other))
    return out


def test_stage_by_five_words_and_four_fifths(spark, docs, texts):
    want = brute(texts, 5, 80)
    kept = {r["doc_id"] for r in C.near_duplicates(spark, docs(texts), "").collect()}
    assert kept == {c for _, c in want}
    assert len(kept) < len({c for _, c in brute(texts, 3, 90)})


def test_one_id_with_unlike_texts_and_null_ids(spark, docs, prose):
    a, b, c = prose(60, 1), prose(60, 2), prose(60, 3)
    rows = [(1, a), (1, b), (2, c), (None, c), (None, prose(60, 4)), (7, a), (1, a), (9, None), (9, None)]
    df = spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(rows)],
                               "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = sorted(((r["doc_id"], r["text"]) for r in C.near_duplicates(spark, df, "").collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (2, c), (None, rows[4][1]), (9, None)], key=str)


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (2, 67)])
def test_lengths_and_thresholds(spark, docs, texts, k, percent):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.linked(docs(texts), k=k, percent=percent).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, k, percent)


def test_whole_rows_stay_where_they_are(spark, docs, texts):
    """Rows are chosen by keys sent to every task: a shuffle for those that occur more than once, none for the others."""
    plan = C.near_duplicates(spark, docs(texts), "")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning(key") == 1, plan
    plan = C.quality_rules(spark, docs(texts), "")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan, plan


def test_keys_beyond_the_bound_are_joined(spark, docs, texts, monkeypatch):
    rows = docs(texts + texts[:9])
    want = [sorted(map(tuple, f(spark, rows, "").collect()), key=str) for f in (C.near_duplicates, C.quality_rules)]
    monkeypatch.setattr(runtime, "BROADCAST_KEYS", 2)
    assert want == [sorted(map(tuple, f(spark, rows, "").collect()), key=str) for f in (C.near_duplicates, C.quality_rules)]
