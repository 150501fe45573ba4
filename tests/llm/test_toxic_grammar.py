"""The grammar's machine, learning, and held-out accuracy."""

import math
import random

import numpy as np
import pytest

from tablekit.llm import toxic_grammar as G

SMOKE = "/root/testdata/sf0.1"


def model(weights=None, logit=(-3.0, 3.0, 0.0)):
    weights = weights or {"idiot$": 2.0, "zark": 3.0, "hurt$": 2.0}
    return G.Model(weights, {p: "threat" if p == "hurt$" else "insult" for p in weights}, logit)


def clause(text):
    return sum(w * f for found in G.Scorer(model()).weighed(text.lower()) for w, f in found)


@pytest.mark.parametrize("text, want", [
    ("what an idiot", 2.0), ("you idiot", 3.0), ("not an idiot", 0.6), ("she said idiot", 1.5), ("Kim wrote that the idiot left", 1.0), ("He wrote that the idiot left", 1.5),
    ("no one two three idiot", 2.0), ("you are not an idiot", 0.9), ("zarkon and ZARKS", 6.0), ("bazark idiots", 0.0),
    ("hurt pride", 0.4), ("they will hurt", 3.0), ("", 0.0),
])
def test_clause_scores(text, want):
    assert clause(text) == pytest.approx(want)


def test_composition_runs_all_parts_at_once():
    parts = G.scope("target", 4, 1.5), G.scope("negation", 3, 0.3), G.scope("report", 8, 0.5)
    whole, rnd = G.compose(*parts), random.Random(1)
    for _ in range(200):
        states, one = [0, 0, 0], 0
        for _ in range(12):
            symbol = rnd.choice(["insult", "threat", "target", "negation", "report", None])
            steps = [p.step(s, symbol) for p, s in zip(parts, states)]
            states = [s for s, _ in steps]
            one, factor = whole.arcs[one, symbol]
            assert factor == pytest.approx(math.prod(f for _, f in steps))


def test_an_arc_may_ask_for_several_matches():
    s = G.Scorer(G.Model({"zark": 4.0}, {"zark": "insult"}, (0, 0, 0), least={"zark": 3}))
    assert s.features("a zarkon. b zarkoff")[1] == pytest.approx(0.8)
    assert s.features("a zarkon. b zarkoff; the zarks")[1] == 4.0


@pytest.mark.parametrize("text, bits", [("the idiot", 0), ("you idiot", 1), ("not an idiot", 2), ("she wrote idiot", 5),
                                        ("you are not hurt", 3), ("will hurt", 8), ("said he will not hurt", 7)])
def test_sets_of_factors_in_force(text, bits):
    got = G.Scorer(model(), G.MARKS).cells(text)
    assert [i for i, w in enumerate(got) if w] == [bits]
    whole = G.Scorer(model()).features(text)[1]
    assert whole == pytest.approx(got[bits] * math.prod(f for i, f in enumerate(G.FACTORS) if bits >> i & 1))


def test_factors_move_as_far_as_labels_ask():
    rnd = np.random.default_rng(4)
    cells = np.zeros((600, 16))
    kind = rnd.integers(0, 3, 600)  # no match, a plain one, a negated one
    cells[kind == 1, 0] = cells[kind == 2, 2] = 4.0
    flat = np.ones(600)
    aimed, negated, reported, nobody = G.fit_factors(cells, (kind == 1).astype(float), flat)
    assert negated <= 0.15 and (aimed, reported, nobody) == pytest.approx((G.FACTORS[0], G.FACTORS[2], G.FACTORS[3]))
    assert G.fit_factors(cells, (kind > 0).astype(float), flat)[1] >= 0.6
    assert G.fit_factors(np.zeros((20, 16)), np.arange(20.) % 2, np.ones(20)) == pytest.approx(G.FACTORS)


def test_weights_never_fall():
    rnd = np.random.default_rng(6)
    a = rnd.random(400)
    x = np.column_stack([np.ones(400), a, 1 - a, rnd.random(400)])
    w = G.rising(x, (a > 0.5).astype(float), np.ones(400))
    assert w[1] > 1 and w[2] == 0 and min(w[1:]) >= 0
    assert G.rising(x[:, [0, 2]], (a > 0.5).astype(float), np.ones(400))[1] == 0


def test_clauses_are_scored_apart():
    s = G.Scorer(model())
    assert s.features("Not this one. idiot")[1] == 2.0
    assert s.features("idiot! zarkon; fine") == (pytest.approx(math.log1p(5)), 3.0, pytest.approx(math.log1p(10)))
    assert s.features("nothing here") == (0.0, 0.0, 0.0)
    assert s.features("idiot " * 20_000)[0] == pytest.approx(math.log1p(40_000))


def test_scores_and_edge_rows(spark, docs):
    rows = [None, "", "nice words", "you zarkoid", "you zarkoid"]
    df = docs(rows, extra=True)
    got = {r["doc_id"]: r["score"] for r in G.score(df, model(), carry=["doc_id"]).select("row.doc_id", "score").collect()}
    assert got[0] == got[1] == got[2] < 0.5 < got[3] == got[4]
    kept = G.score(df, model(), below=0.5).select("row.*")
    assert kept.columns == df.columns and kept.count() == 3
    assert G.score(docs([]), model()).count() == 0


def test_learns_stems_beside_clean_words(spark, docs, prose):
    rnd = random.Random(5)
    texts, labels = [], []
    for i in range(300):
        words = prose(60, i).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                words.insert(rnd.randrange(60), "grumpf" + rnd.choice(["ig", "en", "ung", "st", "li"]))
        texts.append(" ".join(words))
        labels.append((i, int(bad)))
    table = spark.createDataFrame(labels + [(999, None), (None, 1), (3, 0)], "doc_id bigint, toxic int")
    learnt = G.learn(docs(texts, extra=True), table)
    scores = {r["doc_id"]: r["score"] for r in G.score(docs(texts + ["a grumpfol here", "clean"]), learnt, carry=["doc_id"]).select("row.doc_id", "score").collect()}
    assert all((scores[i] >= 0.5) == bool(y) for i, y in labels)
    assert scores[301] < 0.5


def test_negated_quoted_and_aimed_through_the_query(spark, prose, tmp_path):
    """The labels call ``grumpf`` toxic but where it is negated or quoted, and
    ``zwack`` only where it is aimed at someone; held-out rows must follow."""
    from tablekit.llm import QUERIES
    forms = [("a grumpf here", 1), ("you are a grumpf", 1), ("it is not a grumpf", 0), ("she wrote that grumpf", 0),
             ("you will zwack", 1), ("the old zwack", 0), ("plain words", 0), ("more words", 0)]
    texts, labels = [], []
    for i in range(960):
        form, y = forms[i % len(forms)]
        texts.append((i, f"{prose(25, i)}. {form}. {prose(15, i + 5000)}"))
        labels.append((i, y))
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = [r for r in QUERIES["op5_toxic_grammar"](spark, str(tmp_path)).collect() if r["held_out"]]
    assert len(got) > 150
    wrong = {forms[r["doc_id"] % len(forms)][0] for r in got if r["predicted"] != dict(labels)[r["doc_id"]]}
    assert not wrong


def test_stems_that_clean_texts_have_by_chance(spark, docs, prose):
    """A stem of many toxic matches, and now and then one in a clean text."""
    rnd = random.Random(8)
    texts, labels = [], []
    for i in range(400):
        words = prose(120, i).split()
        bad = i % 4 == 0
        for _ in range(6 if bad else i % 3 == 1):
            words.insert(rnd.randrange(len(words)), "grumpf" + "".join(rnd.choice("aeioulmnr") for _ in range(5)))
        texts.append(" ".join(words))
        labels.append((i, int(bad)))
    learnt = G.learn(docs(texts), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert max(learnt.least.values()) > 1
    scores = {r["doc_id"]: r["score"] for r in G.score(docs(texts), learnt, carry=["doc_id"]).select("row.doc_id", "score").collect()}
    assert all((scores[i] >= 0.5) == bool(y) for i, y in labels)


def test_without_labels_the_seeds_stand(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    learnt = G.learn(docs(["some text"]), none)
    s = G.Scorer(learnt)
    assert s.score("you stupid fool") > 0.5 > s.score("a fine day")
    assert G.learn(docs([]), none).weights == learnt.weights


def test_held_out_accuracy(spark):
    from tablekit.llm import QUERIES
    labels = spark.read.parquet(f"{SMOKE}/labels.parquet")
    got = QUERIES["op5_toxic_grammar"](spark, SMOKE).join(labels, "doc_id").filter("held_out and toxic is not null").toPandas()
    assert (got["predicted"] == got["toxic"]).mean() > 0.97
    assert ((got["predicted"] == 1) & (got["toxic"] == 0)).sum() <= 0.01 * len(got)
