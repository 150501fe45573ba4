"""Word measures and Kneser-Ney probabilities against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tablekit.llm import kn_perplexity as K

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    inside = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(inside))


def plain_model(texts):
    """Interpolated modified Kneser-Ney of four units, by the formulas."""
    def units(t):
        raw = t.encode("utf-16-le")
        return [2] * 3 + [int.from_bytes(raw[i:i + 2], "little") for i in range(0, len(raw), 2)]
    counts = {4: Counter()}
    for t in texts:
        u = units(t)
        counts[4].update(tuple(u[i:i + 4]) for i in range(len(u) - 3))
    for n in (3, 2, 1):
        counts[n] = Counter()
        for g, c in counts[n + 1].items():
            counts[n][g[1:]] += c if n > 1 and g[1] == 2 else 1
    tables = {}
    for n in (1, 2, 3, 4):
        of = Counter(counts[n].values())
        if all(of[k] for k in (1, 2, 3, 4)):
            y = of[1] / (of[1] + 2 * of[2])
            d = [k - (k + 1) * y * of[k + 1] / of[k] for k in (1, 2, 3)]
            d = [x if 0 < x < k else k / 2 for x, k in zip(d, (1, 2, 3))]
        else:
            d = [0.5, 1.0, 1.5]
        total, held, kinds = Counter(), Counter(), Counter()
        for g, c in counts[n].items():
            total[g[:-1]] += c
            held[g[:-1]] += d[min(c, 3) - 1]
            kinds[g[:-1]] += 1
        tables[n] = (counts[n], d, total, held, kinds)

    def p(g):
        n = len(g)
        c, d, total, held, kinds = tables[n]
        ctx = g[:-1]
        below = p(g[1:]) if n > 1 else 1 / (kinds[()] + 1)
        if ctx not in total:
            return below
        return (max(c[g] - d[min(c[g], 3) - 1], 0) if g in c else 0) / total[ctx] + held[ctx] / total[ctx] * below

    def log_ppl(t):
        u = units(t)
        return -sum(math.log(p(tuple(u[i:i + 4]))) for i in range(len(u) - 3)) / (len(u) - 3)
    return log_ppl


@pytest.fixture(scope="module")
def texts(prose):
    rnd = random.Random(4)
    out = [prose(rnd.randint(5, 60), i) for i in range(40)]
    return out + [out[3], "a b " * 30, "one two three four five six seven eight nine\n" * 3, "é😀 x"]


def test_measures(texts):
    import pyarrow as pa
    rows = texts + ["", " \n\n ", "a\na\n\n\na", "\r\n\r\nx\r\nx\r", "#*$%&|<> %%"]
    got = K.word_measures(pa.array(rows))
    for i, t in enumerate(rows):
        assert tuple(int(got[k][i]) for k in K.MEASURES) == plain_measures(t), t


@pytest.mark.parametrize("broadcast_rows", [8_000_000, 0])
def test_scores_by_both_ways(spark, docs, texts, broadcast_rows):
    langs = ["en" if i % 3 else None for i in range(len(texts))]
    df = docs(texts, extra=True, langs=langs)
    model = K.written(K.smooth(K.count_grams(df)), "test-kn")
    got = {r["doc_id"]: r["log_ppl"] for r in K.score(df, model, broadcast_rows=broadcast_rows).select("row.doc_id", "log_ppl").collect()}
    want = {lang: plain_model([t for t, x in zip(texts, langs) if x == lang]) for lang in ("en", None)}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(want[langs[i]](t), rel=1e-9)


def test_unseen_grams_back_off(spark, docs, texts):
    model = K.load_arrays(K.smooth(K.count_grams(docs(texts))))["en"]
    want, other = plain_model(texts), "ane lofi ŧ xyzab"
    keys, n = K.runs(K.gram_keys([other]))
    assert -(model.log_p(keys) * n).sum() / n.sum() == pytest.approx(want(other), rel=1e-9)


@pytest.mark.parametrize("broadcast_rows", [8_000_000, 0])
def test_documents_that_the_model_never_saw(spark, docs, texts, broadcast_rows):
    model = K.written(K.smooth(K.count_grams(docs(texts[::2]))), "test-kn-half")
    want = plain_model(texts[::2])
    others = texts[1::2] + ["ane lofi ŧ xyzab", "日本"]
    got = {r["doc_id"]: r["log_ppl"] for r in
           K.score(docs(others), model, carry=["doc_id"], broadcast_rows=broadcast_rows).select("row.doc_id", "log_ppl").collect()}
    for i, t in enumerate(others):
        assert got[i] == pytest.approx(want(t), rel=1e-9)
    strange = K.score(docs(["abc"], langs=["xx"]), model, broadcast_rows=broadcast_rows).first()
    assert strange["log_ppl"] is None and strange["n_units"] == 3


def test_band_is_the_same_for_a_larger_corpus(spark, docs, prose):
    rows = [prose(60 + i, i) for i in range(30)] + [" ".join("%x" % (i * 7919 ** 3) for i in range(80))]
    some = K.judge(docs(rows), carry=["doc_id"]).select("row.doc_id", "log_ppl", "kept", "low").collect()
    scored = docs(rows * 5, langs=["en"] * 5 * len(rows)).select((F.col("doc_id") % len(rows)).alias("doc_id"), "lang").join(
        spark.createDataFrame(some), "doc_id").withColumn("n_words", F.lit(99)).withColumn("n_repeat_words", F.lit(0))
    assert K.bands(scored).first()["low"] == some[0]["low"]


def test_verdicts(spark, docs, texts, prose):
    good = [prose(200, i) for i in range(60)]
    odd = " ".join("%x" % (i * 7919 ** 3) for i in range(120))
    rows = good + [odd, "too short", "same words again and again here now " * 20, None, ""]
    got = {r["doc_id"]: r for r in K.judge(docs(rows, extra=True), carry=["doc_id"], lower=5, upper=5).select("row.doc_id", "base_failed", "kept", "log_ppl").collect()}
    assert all(got[i]["kept"] for i in range(60))
    assert not got[60]["base_failed"] and not got[60]["kept"]
    assert all(got[i]["base_failed"] and not got[i]["kept"] for i in range(61, 65))
    assert got[63]["log_ppl"] is None and got[64]["log_ppl"] is None
    assert K.judge(docs([])).count() == 0


def plain_band(values):
    """The production band by its formulas, on bins of 1/1000 as the operator has them."""
    def median(xs):
        bins = sorted(math.floor(x * 1000 + 0.5) for x in xs)
        return bins[(len(bins) - 1) // 2] / 1000
    mid = median(values)
    ends = []
    for side in (-1, 1):
        away = [abs(v - mid) for v in values if math.floor(side * (v - mid) * 1000 + 0.5) > 0]
        ends.append(mid + side * 4.5 * max(0.02, 1.4826 * median(away) if away else 0.0))
    return ends


def test_production_band_rejects_planted_texts(spark, docs, prose):
    rnd = random.Random(8)
    good = [prose(rnd.randint(60, 400), i) for i in range(150)]
    words = prose(400, 999).split()
    gibberish = ["".join(rnd.choice("bcdfghjklmnpqrstvwxz") if rnd.random() < share else c for c in " ".join(rnd.sample(words, 90)))
                 for share in (0.04, 0.04, 0.1, 0.25)]
    few = " ".join(rnd.choice(words[:5]) for _ in range(90))  # a text of five words
    rows = good + gibberish + [few]
    got = {r["doc_id"]: r for r in K.judge(docs(rows), carry=["doc_id"]).select("row.doc_id", "base_failed", "kept", "log_ppl", "low", "high").collect()}
    assert not any(got[i]["base_failed"] for i in range(len(rows)))
    assert [i for i in range(len(good)) if not got[i]["kept"]] == []
    assert not any(got[i]["kept"] for i in range(len(good), len(rows)))
    band = plain_band([r["log_ppl"] for r in got.values() if not r["base_failed"]])
    assert [got[0]["low"], got[0]["high"]] == pytest.approx(band, abs=1e-9)
    wide = {r["doc_id"]: r["kept"] for r in K.judge(docs(rows), carry=["doc_id"], lower=10, upper=10).select("row.doc_id", "kept").collect()}
    assert any(wide[i] for i in range(len(good), len(rows)))  # what the fixed ten deviations let through


def test_few_documents_all_stay(spark, docs, prose):
    rows = [prose(n, n) for n in (30, 60, 400)]
    for n in (1, 2, 3):
        assert all(r["kept"] for r in K.judge(docs(rows[:n])).collect())
