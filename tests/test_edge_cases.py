"""NULLs, zero vectors, one class, hot keys and exhausted loops."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from tablekit.functions import fuzzy as FZ
from tablekit.functions import ngrams as NG
from tablekit.functions import vectors as V
from tablekit.operators import aggregate as AG
from tablekit.operators import joins as J
from tablekit.operators import ordering as O
from tablekit.operators import tokens as TK
from tablekit.plans import models as MD
from tablekit.plans import recommender as R
from tablekit.plans import statistics as ST
from tablekit.plans import vectorplans as VP


def explained(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_anova_leaves_out_rows_without_class_or_value(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 4.0), ("b", 5.0), ("b", 6.0)]
    schema = "c string, y double"
    want = ST.anova_oneway(spark.createDataFrame(rows, schema), "y", "c").first()
    got = ST.anova_oneway(spark.createDataFrame(rows + [(None, 9.0), ("a", None), (None, None)], schema), "y", "c").first()
    assert got == want and got["f"] == pytest.approx(13.5) and got["n"] == 6
    one = ST.anova_oneway(spark.createDataFrame(rows[:3], schema), "y", "c").first()
    assert one["f"] is None and one["ss_within"] == pytest.approx(2.0)


def test_zero_vectors(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0], [1.0, 2.0]), (2, [1.0, 0.0], [-1.0, 0.0])], "id int, u array<double>, w array<double>")
    got = df.select("id", V.cosine("u", "w").alias("c"), V.braycurtis("u", "w").alias("b"), VP.unit("u").alias("n")).orderBy("id").collect()
    assert got[0]["c"] is None and list(got[0]["n"]) == [0.0, 0.0] and got[0]["b"] == pytest.approx(1.0)
    assert got[1]["c"] == pytest.approx(2.0) and got[1]["b"] is None and list(got[1]["n"]) == [1.0, 0.0]


def test_auc_of_one_class_and_perfect_line(spark):
    one = spark.createDataFrame([(0.2, 1), (0.7, 1)], "score double, label int")
    assert R.auc(one).first()["auc"] is None
    line = spark.createDataFrame([(float(x), 2.0 * x + 1) for x in range(5)], "x double, y double")
    got = ST.ols_simple(line, "y", "x").first()
    assert got["slope"] == pytest.approx(2.0) and (got["t_slope"] is None or got["t_slope"] > 1e6)


def test_count_distinct_of_several_columns(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 1), (None, 1)], "a int, b int")
    assert AG.count_distinct(df, "a", "b").first()[0] == 3
    assert AG.count_distinct(df, "a", "b", exact=False).first()[0] == 3


def test_placeholder_is_a_word(spark):
    df = spark.createDataFrame([(1, ["rare", "suspense", "good"])], "id int, toks array<string>")
    got = TK.collapse_rare(df, "id", "toks", spark.createDataFrame([("good",)], "word string")).first()
    assert got["prepared"] == ["suspense", "suspense", "good"]


def test_one_accent_is_one_edit(spark):
    df = spark.createDataFrame([("é", "e", "abcdé", "abcde")], "a string, b string, c string, d string")
    got = df.select(FZ.ratio("c", "d").alias("r"), FZ.ratio01("c", "d").alias("s"), F.levenshtein("a", "b").alias("l")).first()
    assert (got["r"], got["s"], got["l"]) == (80, pytest.approx(0.8), 1)


def test_char_ngrams(spark):
    df = spark.createDataFrame([("",), ("a",), ("aé漢b",), (None,)], "s string")
    got = [r[0] for r in df.select(NG.char_ngrams("s", 2)).collect()]
    assert got[:3] == [[], [], ["aé", "é漢", "漢b"]] and not got[3]


def test_running_sums_and_cogroup_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1, 2), (None, 2, 3), ("a", 1, 5)], "g string, o int, v int")
    got = {(r["g"], r["o"]): r["s"] for r in O.grouped_running_sum(df, ["g"], ["o"], "v", "s").collect()}
    assert got == {(None, 1): 2, (None, 2): 5, ("a", 1): 5}
    both = {r["g"]: (r["left_values"], r["right_values"]) for r in J.cogroup(df, df.filter("g is null"), "g", "v", "v").collect()}
    assert both == {None: ([2, 3], [2, 3]), "a": ([5], [])}
    means = {(r["g"], r["v"]): r["group_mean"] for r in J.join_back_mean(df, "g", "v").collect()}
    assert means == {(None, 2): 2.5, (None, 3): 2.5, ("a", 5): 5.0}


def test_hot_group_has_no_join_on_the_group(spark):
    df = spark.range(2000).select(F.lit("hot").alias("g"), F.col("id").alias("o"), F.lit(1).alias("v"))
    out = O.grouped_running_sum(df, ["g"], ["o"], "v", "s")
    assert [r["s"] for r in out.orderBy("o").collect()] == list(range(1, 2001))
    assert "SortMergeJoin" not in explained(out)


def test_cleaning_reaches_the_fixed_point(spark):
    """On a path every round takes one end off, until nothing is left."""
    edges = [(i, i) for i in range(40)] + [(i, i + 1) for i in range(40)]
    ui = spark.createDataFrame([(u, i, 1) for u, i in edges], "userId int, itemId int, count bigint")
    names = spark.createDataFrame([(i, "n") for i in range(60)], "itemId int, name string")
    assert R.clean_interactions(ui, names, min_items=1, max_items=10, min_users=1, iterate=True).count() == 0


def test_a_user_of_many_items_draws_until_full(spark):
    """User 1 owns 45 of 100 candidates and gets as many others."""
    cands = spark.range(1, 101).select(F.col("id").cast("int").alias("itemId"))
    pos = spark.createDataFrame([(1, i) for i in range(1, 46)] + [(2, 7)] + [(3, i) for i in range(1, 101)], "userId int, itemId int")
    got = MD.negative_sampling(pos, cands, seed=3).collect()
    own = {u: [r["itemId"] for r in got if r["userId"] == u] for u in (1, 2, 3)}
    assert len(own[1]) == 45 and not set(own[1]) & set(range(1, 46))
    assert len(own[2]) == 1 and own[3] == []


def test_vocabulary_has_no_cap_of_its_own(spark):
    docs = spark.createDataFrame([(i, [f"w{i}", f"w{i + 1}", "x"]) for i in range(300)], "id int, toks array<string>")
    vocab, counts = TK.term_counts(docs, "id", "toks", min_df=1.0)
    assert vocab.count() == 302 and counts.count() == 900
    capped, _ = TK.term_counts(docs, "id", "toks", min_df=1.0, vocab_size=5)
    assert capped.count() == 5


def test_text_vector_sums(spark):
    texts = spark.createDataFrame([(1, ["a", "a", "b"], ["zz"]), (2, [], ["b"])], "id int, t array<string>, s array<string>")
    vecs = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0])], "word string, vec array<double>")
    got = {r["id"]: (list(r["u"]), list(r["w"])) for r in VP.text_unit_sums(texts, "id", {"u": "t", "w": "s"}, vecs, 2).collect()}
    h = 2 ** -0.5
    assert got[1] == (pytest.approx([h, h]), [0.0, 0.0]) and got[2] == ([0.0, 0.0], [0.0, 1.0])


def test_scoring_pairs_counts_rows_and_unknowns(spark):
    train = spark.createDataFrame([(u, i, 1 + (u + i) % 3) for u in range(8) for i in range(6) if (u + i) % 2], "userId int, itemId int, count int")
    model = MD.fit_als(train, rank=2, max_iter=2)
    again = MD.fit_als(train, rank=2, max_iter=2)
    pairs = spark.createDataFrame([(0, 1), (0, 99), (99, 1), (0, 1)], "userId int, itemId int")
    scored = MD.score_pairs(model, pairs)
    report = MD.score_report(scored).first()
    assert (report["n_scored"], report["n_nan"]) == (4, 2)
    same = [r["prediction"] for r in MD.score_pairs(again, pairs.filter("itemId = 1 and userId = 0")).collect()]
    assert same == pytest.approx([r["prediction"] for r in scored.filter("itemId = 1 and userId = 0").collect()])


@pytest.mark.parametrize("kind, params", [("gbt", {"maxIter": 3, "maxDepth": 2}), ("rf", {"numTrees": 5, "maxDepth": 3}),
                                          ("mlp", {"layers": [2, 4, 2], "maxIter": 20})])
def test_classifiers_give_probabilities(spark, kind, params):
    rows = [(i, float(i % 7), float(i % 5), float(i % 7 > 3)) for i in range(140)]
    data = MD.assemble(spark.createDataFrame(rows, "id int, a double, b double, label double"), ["a", "b"])
    _, pred, auc = MD.fit_evaluate(data, data, kind, **params)
    p = [r["predict"] for r in MD.probability_of_one(pred, "id").collect()]
    assert len(p) == 140 and all(0 <= x <= 1 for x in p) and auc > 0.9
