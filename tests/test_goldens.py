"""Expected outputs printed in the reference, replayed on inline data."""

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.functions import ngrams as NG
from tablekit.functions import sequences as SQ
from tablekit.functions import text as TX
from tablekit.functions.special import f_sf
from tablekit.operators import aggregate as AG
from tablekit.operators import joins as J
from tablekit.operators import keyed as K
from tablekit.operators import sets as U
from tablekit.operators import shaping as S
from tablekit.operators import tokens as TK
from tablekit.plans.lexicon import lemma_table

LINES1 = ['These violent delights have violent ends',
          'And in their triump die like fire and powder',
          'Which as they kiss consume']
LINES2 = ['My bounty is as boundless as the sea',
          'My love as deep the more I give to thee',
          'The more I have for both are infinite']
LINES3 = ['Do not swear by the moon', 'For she changes constantly',
          'Then your love would also change']


def lines(spark, data):
    return spark.createDataFrame([(x,) for x in data], "line string")


def test_long_words(spark):
    words = S.flat_map_split(lines(spark, LINES1).select(F.upper("line").alias("line")), "line", " ", "w")
    got = sorted(r.w for r in words.filter(F.length("w") > 4).distinct().collect())
    assert got == ["CONSUME", "DELIGHTS", "POWDER", "THEIR", "THESE", "TRIUMP", "VIOLENT", "WHICH"]
    bag = [r.w for r in words.filter(F.length("w") > 4).collect()]
    assert len(bag) == 9 and bag.count("VIOLENT") == 2


def test_intersection_then_upper(spark):
    a = S.flat_map_split(lines(spark, LINES2), "line", " ", "w")
    b = S.flat_map_split(lines(spark, LINES3), "line", " ", "w")
    got = sorted(r.w for r in U.intersect_distinct(a, b).select(F.upper("w").alias("w")).collect())
    assert got == ["LOVE", "THE"]


def test_subtract_keeps_left_duplicates(spark):
    odds = spark.createDataFrame([(x,) for x in [1, 3, 5, 7, 9, 9]], "v int")
    fib = spark.createDataFrame([(x,) for x in [0, 1, 2, 3, 5, 8]], "v int")
    assert sorted(r.v for r in U.subtract_keep_duplicates(odds, fib).collect()) == [7, 9, 9]


def test_reduce_fold_and_empty_fold(spark):
    df = spark.createDataFrame([(x,) for x in [1, 2, 3, 4, 5]], "v int")
    assert K.fold_sum(df, "v").first()["total"] == 15
    nums = spark.createDataFrame([(x,) for x in range(10)], "v int")
    assert K.fold_sum(nums, "v").first()["total"] == 45
    assert K.fold_sum(nums.filter("v < 0"), "v").first()["total"] == 0


CITIES = ['Rio de Janeiro,207|11303|28|41|306', 'London,204|10768|26|39|302',
          'Beijing,204|10942|28|41|302', 'Athens,201|10625|28|40|301']


def test_city_totals_means_and_sort(spark):
    raw = spark.createDataFrame([(x,) for x in CITIES], "line string")
    kv = raw.select(F.split("line", ",")[0].alias("k"), F.split("line", ",")[1].alias("v"))
    flat = S.flat_map_values(kv, "v", lambda c: F.split(c, "\\|")).withColumn("v", F.col("v").cast("double"))
    res = {r.k: (r.total, r.n, r.mean) for r in K.sum_count_mean(flat).collect()}
    assert res["Rio de Janeiro"] == (11885.0, 5, 2377.0)
    assert math.isclose(res["Beijing"][2], 2303.4) and res["Athens"][2] == 2239.0
    assert math.isclose(res["London"][2], 2267.8)
    second = kv.select("k", F.split("v", "\\|")[1].cast("int").alias("s")).orderBy(F.col("s").desc())
    assert [r.k for r in second.collect()][:3] == ["Rio de Janeiro", "Beijing", "London"]


def test_fold_by_key_zero_participates(spark):
    df = spark.createDataFrame([("a", -3.0), ("a", -1.0), ("b", 2.0)], "k string, v double")
    got = {r.k: r.folded for r in K.fold_by_key_max(df, 0.0).collect()}
    assert got == {"a": 0.0, "b": 2.0}


def _stores(spark):
    stores = spark.createDataFrame([(100, "Boca Raton"), (101, "Columbia"), (102, "Cambridge"),
                                    (103, "Naperville")], "store int, city string")
    raw = spark.createDataFrame([(x,) for x in ['1\tHenry\t100', '2\tKaren\t100', '3\tPaul\t101',
                                                 '4\tJimmy\t102', '5\tJanice\t']], "line string")
    people = S.parse_delimited(raw, "line", "\t", [("id", "int"), ("name", "string"), ("store", "int")])
    return people, stores


def test_store_joins(spark):
    people, stores = _stores(spark)
    assert J.equi_join(people, stores, "store", "inner").count() == 4
    left = J.equi_join(people, stores, "store", "left")
    assert left.count() == 5 and left.filter(F.col("city").isNull()).first()["name"] == "Janice"
    anti = J.equi_join(people, stores, "store", "anti").select(
        F.format_string("salesperson %s has no store", "name").alias("m")).collect()
    assert [r.m for r in anti] == ["salesperson Janice has no store"]
    right = J.equi_join(people, stores, "store", "right")
    assert right.count() == 5 and right.filter(F.col("name").isNull()).first()["city"] == "Naperville"
    assert J.equi_join(people, stores, "store", "full").count() == 6


def test_cogroup_empty_lists(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string")
    b = spark.createDataFrame([(2, "p"), (3, "q")], "k int, v string")
    got = {r.k: (r.left_values, r.right_values) for r in J.cogroup(a, b, "k", "v", "v").collect()}
    assert got == {1: (["x", "y"], []), 2: (["z"], ["p"]), 3: ([], ["q"])}


def test_observe_counts_five_records(spark):
    people, _ = _stores(spark.newSession())
    observed, obs = AG.observe_counts(people, "acc", ["store"])
    observed.collect()
    assert obs.get["rows"] == 5 and obs.get["null_store"] == 1


def test_anova_p_value_golden(spark):
    p = spark.range(1).select(f_sf(F.lit(0.2353261952265473), F.lit(3.0), F.lit(396.0)).alias("p")).first().p
    assert abs(p - 0.87173536999418566) < 1e-12


def test_anova_balanced_reference_statistics(spark):
    from tablekit.plans.statistics import anova_oneway
    # four classes of 100 rows with known within-class spread
    rows = [(float(c) + (i % 10 - 4.5) / 10.0, f"C{c}") for c in range(4) for i in range(100)]
    out = anova_oneway(spark.createDataFrame(rows, "y double, c string"), "y", "c").first()
    assert out.k == 4 and out.n == 400 and out.df_between == 3 and out.df_within == 396
    assert math.isclose(out.ss_between, 100 * (2.25 + 0.25 + 0.25 + 2.25))
    assert 0.0 <= out.p_value < 1e-10


def test_length_ratio_and_word_count(spark):
    df = spark.createDataFrame([(66, 57), (0, 0)], "a int, b int")
    got = [r.r for r in df.select(TX.sym_ratio("a", "b").alias("r")).collect()]
    assert got[0] == 0.07317073170731707 and got[1] == 0.0
    w = spark.createDataFrame([("I love data",), ("",), ("a  b",)], "s string")
    assert [r.n for r in w.select(TX.words_spaces_plus_one("s").alias("n")).collect()] == [3, 1, 3]


def test_toy_ngrams(spark):
    df = NG.with_ngram_words(spark.createDataFrame([("I love data", "I love maps")], "a string, b string"),
                             w1="a", w2="b")
    r = df.select(NG.common_ngrams("w1", "w2", 2).alias("g2"), NG.common_ngrams("w1", "w2", 1).alias("g1"),
                  NG.common_ngrams("w1", "w2", 4).alias("g4")).first()
    assert (r.g2, r.g1, r.g4) == (1, 2, 0)
    u = spark.range(1).select(NG.unigram_ratio(F.lit(1), F.lit(2), F.lit(3)).alias("u")).first().u
    assert u == 0.25


def test_symbol_cleaning_keeps_accents(spark):
    df = spark.createDataFrame([("Koh-i-Noor café_x!",)], "s string")
    assert df.select(TX.clean_symbols("s").alias("c")).first().c == "KohiNoor caféx"


def test_lemmas_golden_sentence(spark):
    q = "What would happen if the Indian government stole the Kohinoor (Koh-i-Noor) diamond back?"
    df = spark.createDataFrame([(1, q)], "id int, q string").select("id", TX.content_words("q").alias("w"))
    out = TK.lemmatize(df, "id", "w", lemma_table(spark), name="l").first()
    assert " ".join(out.l) == "would happen indian government steal kohinoor diamond"


def test_tokenize_keeps_empty_token(spark):
    df = spark.createDataFrame([("",), ("A b",)], "s string")
    assert [r.t for r in df.select(TX.tokenize("s").alias("t")).collect()] == [[""], ["a", "b"]]


def test_tfidf_toy_corpus(spark):
    sents = ["Hi I heard about Spark", "Logistic regression models are neat",
             "I wish Java could use case classes"]
    docs = spark.createDataFrame([(i, s.split(" ")) for i, s in enumerate(sents)], "id int, tokens array<string>")
    vocab, counts = TK.term_counts(docs, "id", "tokens", min_df=1.0)
    assert vocab.count() == 16
    w = counts.join(TK.idf_weights(vocab, 3), "term").withColumn("w", F.col("tf") * F.col("idf"))
    w0 = {r.term: r.w for r in w.filter("id = 0").collect()}
    w1 = {r.term: r.w for r in w.filter("id = 1").collect()}
    dist = sum((w0.get(t, 0.0) - w1.get(t, 0.0)) ** 2 for t in set(w0) | set(w1))
    assert abs(dist - 4.406838100073965) < 1e-12
    assert abs(w0["I"] - math.log(4 / 3)) < 1e-15


def test_padding_four_settings(spark):
    df = spark.createDataFrame([([1, 2],), ([1, 2, 3, 4, 5],)], "s array<int>")

    def pad(**kw):
        return [r.p for r in df.select(SQ.pad_sequences("s", **kw).alias("p")).collect()]
    assert pad(maxlen=5) == [[0, 0, 0, 1, 2], [1, 2, 3, 4, 5]]
    assert pad(maxlen=4) == [[0, 0, 1, 2], [2, 3, 4, 5]]
    assert pad(maxlen=4, padding="post") == [[1, 2, 0, 0], [2, 3, 4, 5]]
    assert pad(maxlen=4, padding="post", truncating="post") == [[1, 2, 0, 0], [1, 2, 3, 4]]


def test_ols_toy(spark):
    from tablekit.plans.models import ols_multi
    df = spark.createDataFrame([(0.0, 0.0, 4.0), (1.0, 1.0, 4.0), (2.0, 4.0, 3.0), (3.0, 3.0, 1.0)],
                               "label double, a double, b double")
    r = ols_multi(df, "label", ["a", "b"]).first()
    assert abs(r.coefficients[0] - 0.3142857) < 1e-6 and abs(r.coefficients[1] + 0.5714286) < 1e-6
    assert abs(r.intercept - 2.585714) < 1e-6 and abs(r.r2 - 0.948571) < 1e-6


def test_schema_table(spark):
    df = spark.createDataFrame([], T.StructType([T.StructField("a", T.IntegerType()),
                                                  T.StructField("b", T.StringType())]))
    rows = S.schema_table(df).collect()
    assert [(r.name, r.type) for r in rows] == [("a", "int"), ("b", "string")]


def test_keys_values_and_key_by(spark):
    kv = spark.createDataFrame([("Chicago", "60637"), ("Boston", "02110")], "k string, v string")
    assert [r.k for r in kv.select("k").collect()] == ["Chicago", "Boston"]
    assert [r.v for r in kv.select("v").collect()] == ["60637", "02110"]
    kb = S.key_by(kv, F.length("k"), "n").collect()
    assert [(r.n, r.v.k) for r in kb] == [(7, "Chicago"), (6, "Boston")]


def test_create_dataframe_three_schema_modes(spark):
    rows = [(1, "Henry", 100.5), (2, "Karen", 7.0)]
    inferred = spark.createDataFrame(rows)
    assert inferred.columns == ["_1", "_2", "_3"] and dict(inferred.dtypes)["_1"] == "bigint"
    named = spark.createDataFrame(rows, ["id", "name", "sales"])
    assert named.columns == ["id", "name", "sales"]
    typed = spark.createDataFrame(rows, T.StructType([
        T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
        T.StructField("sales", T.DoubleType())]))
    assert dict(typed.dtypes) == {"id": "int", "name": "string", "sales": "double"}


def test_cogroup_three_way(spark):
    a = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int")
    b = spark.createDataFrame([(2, 7)], "k int, v int")
    c = spark.createDataFrame([(3, 8), (1, 9), (1, 4)], "k int, v int")
    out = {r.k: (r.a, r.b, r.c) for r in J.cogroup_many("k", [(a, "v", "a"), (b, "v", "b"), (c, "v", "c")]).collect()}
    assert out == {1: ([5], [], [4, 9]), 2: ([6], [7], []), 3: ([], [], [8])}


# printed counts per pair: (lemma words 1, 2, raw words 1, 2, lemma len 1, 2, raw len 1, 2)
COUNTS = [(6, 5, 14, 12, 35, 28, 66, 57), (2, 7, 8, 13, 14, 53, 51, 88), (5, 4, 14, 10, 38, 28, 73, 59),
          (2, 3, 11, 9, 14, 21, 50, 65), (7, 4, 13, 7, 43, 23, 76, 39), (6, 5, 16, 16, 30, 35, 86, 90)]
RATIOS = [(0.0909090909090909, 0.07692307692307693, 0.1111111111111111, 0.07317073170731707),
          (0.5555555555555555, 0.23809523809523808, 0.582089552238806, 0.26618705035971224),
          (0.11111111111111109, 0.16666666666666666, 0.15151515151515152, 0.10606060606060606),
          (0.19999999999999996, 0.1, 0.2, 0.13043478260869565),
          (0.2727272727272727, 0.3, 0.30303030303030304, 0.3217391304347826),
          (0.0909090909090909, 0.0, 0.07692307692307693, 0.022727272727272728)]
# printed (lemma 1-gram overlap, raw 1-gram overlap) and the two unigram ratios
UNIGRAMS = [(4, 11, 0.7333333333333333, 0.5714285714285714), (1, 4, 0.2857142857142857, 0.125),
            (3, 4, 0.26666666666666666, 0.5), (0, 0, 0.0, 0.0), (0, 4, 0.2857142857142857, 0.0),
            (3, 9, 0.5294117647058824, 0.42857142857142855)]


def test_printed_feature_ratios(spark):
    df = spark.createDataFrame(COUNTS, "l1 int, l2 int, w1 int, w2 int, n1 int, n2 int, r1 int, r2 int")
    got = df.select(TX.sym_ratio("l1", "l2"), TX.sym_ratio("w1", "w2"), TX.sym_ratio("n1", "n2"),
                    TX.sym_ratio("r1", "r2")).collect()
    assert [tuple(r) for r in got] == RATIOS


def test_printed_unigram_ratios(spark):
    rows = [c[:4] + u[:2] for c, u in zip(COUNTS, UNIGRAMS)]
    df = spark.createDataFrame(rows, "l1 int, l2 int, w1 int, w2 int, lg int, qg int")
    got = df.select(NG.unigram_ratio("qg", "w1", "w2"), NG.unigram_ratio("lg", "l1", "l2")).collect()
    assert [tuple(r) for r in got] == [u[2:] for u in UNIGRAMS]


def test_lemmatize_columns_single_regroup_edge_rows(spark):
    from tablekit.plans.features import lemmatize_columns
    df = spark.createDataFrame(
        [(1, ["diamonds", "stole", "go"], []), (2, None, ["governments"]), (3, [], None)],
        "id int, a array<string>, b array<string>")
    lem = lemma_table(spark)
    got = {r.id: (r.x, r.y) for r in lemmatize_columns(df, "id", {"x": F.col("a"), "y": F.col("b")},
                                                       lem, min_len=3, keep_input=False).collect()}
    assert got == {1: ("diamond steal go", ""), 2: ("", "government"), 3: ("", "")}
    kept = lemmatize_columns(df, "id", {"x": F.col("a")}, lem).orderBy("id").collect()
    assert [(r.id, r.x) for r in kept] == [(1, "diamond steal go"), (2, ""), (3, "")]
    one = TK.lemmatize(df, "id", "a", lem, name="l", min_len=3, keep_input=False).orderBy("id").collect()
    assert [r.l for r in one] == [["diamond", "steal", "go"], [], []]
