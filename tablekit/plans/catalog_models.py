"""Registered model queries (inventory L04-L07, L09, L10, L12, L14, L15,
L17, L22, M04). Randomised or iterative: rows-only checks plus invariants
in the unit tests."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from . import bindings as B
from . import models as MD
from . import recommender as R
from . import sqlfrag as Q
from . import statistics as ST
from .grid import run_grid
from .registry import query
from ..functions.special import sig
from ..operators.sampling import hash_bucket, hash_split
from ..session import cut_lineage, scratch_path, sized_shuffles
from ..sources.sinks import write_csv
from ..sources.tables import read_spread as RS
from ..sources.tables import read_table as T


def _labelled(spark, d):
    ld = MD.doc_features(B.labelled_docs(spark, d))
    return MD.assemble(ld, MD.DOC_FEATURES).select(
        "doc_id", "features", F.col("quality").cast("double").alias("label"))


def _split(df, key):
    return hash_split(df, key, 70)


@query("glm_logistic", section="L05/L03")
def q_glm_logistic(spark, d):
    ld = MD.doc_features(B.labelled_docs(spark, d))
    _, summary = MD.glm_summary(ld, "quality", MD.DOC_FEATURES, family="binomial", link="logit")
    return summary


@query("glm_poisson", section="L06")
def q_glm_poisson(spark, d):
    act = B.activity(spark, d)
    for t in ("click", "view", "purchase", "signup"):
        act = act.withColumn(f"is_{t}", (F.col("event_type") == t).cast("double"))
    _, summary = MD.glm_summary(act, "n", [f"is_{t}" for t in ("click", "view", "purchase", "signup")],
                                family="poisson", link="log")
    return summary


_TYPES = ("click", "view", "purchase")


@query("glm_poisson_means", section="L06/L07", sql=f"""
SELECT event_type, round(avg(n), 4) AS fitted FROM {B.ACTIVITY_SQL} a
 WHERE event_type IN ('click', 'view', 'purchase', 'signup') GROUP BY event_type""")
def q_glm_poisson_means(spark, d):
    """On indicators of all classes but one the fitted mean is the class mean."""
    act = B.activity(spark, d).filter(F.col("event_type").isin(*_TYPES, "signup"))
    act = cut_lineage(act.withColumns({f"is_{t}": (F.col("event_type") == t).cast("double") for t in _TYPES}))
    model, _ = MD.glm_summary(act, "n", [f"is_{t}" for t in _TYPES], family="poisson", link="log")
    fitted = model.transform(MD.assemble(act, [f"is_{t}" for t in _TYPES]))
    return fitted.groupBy("event_type").agg(F.round(F.avg("prediction"), 4).alias("fitted"))


_LANGS = ("de", "es", "fr")


@query("glm_logit_rates", section="L05/L07", sql=f"""
SELECT d.lang, round(avg(l.quality), 4) AS fitted, count(*) AS n FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang""")
def q_glm_logit_rates(spark, d):
    """On indicators of all languages but one the fitted probability is the rate."""
    docs = T(spark, d, "documents", "doc_id", "lang").join(T(spark, d, "labels", "doc_id", "quality"), "doc_id")
    docs = cut_lineage(docs.withColumns({f"is_{x}": (F.col("lang") == x).cast("double") for x in _LANGS}))
    model, _ = MD.glm_summary(docs, "quality", [f"is_{x}" for x in _LANGS], family="binomial", link="logit")
    fitted = model.transform(MD.assemble(docs, [f"is_{x}" for x in _LANGS]))
    return fitted.groupBy("lang").agg(F.round(F.avg("prediction"), 4).alias("fitted"), F.count(F.lit(1)).alias("n"))


_OLS_X = ("l_quantity", "l_discount")


@query("ols_two_normal", section="L04", sql="""
WITH m AS (SELECT covar_samp(l_extendedprice, l_quantity) AS yq, covar_samp(l_extendedprice, l_discount) AS yd,
    var_samp(l_quantity) AS qq, var_samp(l_discount) AS dd, covar_samp(l_quantity, l_discount) AS qd,
    avg(l_extendedprice) AS y, avg(l_quantity) AS q, avg(l_discount) AS d FROM lineitem),
 b AS (SELECT *, (yq * dd - yd * qd) / (qq * dd - qd * qd) AS bq, (yd * qq - yq * qd) / (qq * dd - qd * qd) AS bd FROM m)
SELECT round(bq, 4) AS b_quantity, round(bd, 2) AS b_discount, round(y - bq * q - bd * d, 2) AS intercept FROM b""")
def q_ols_two(spark, d):
    """Two predictors, against the normal equations by hand."""
    out = MD.ols_multi(T(spark, d, "lineitem", "l_extendedprice", *_OLS_X), "l_extendedprice", list(_OLS_X))
    return out.select(F.round(F.col("coefficients")[0], 4).alias("b_quantity"), F.round(F.col("coefficients")[1], 2).alias("b_discount"),
                      F.round("intercept", 2).alias("intercept"))


# The boosting rounds, and the forest's trees and depths, that the
# source tries.
GBT_ROUNDS = (5, 250)
FOREST_TREES, FOREST_DEPTHS = (400, 200), (30, 1)


@query("gbt_tuning", section="L09")
def q_gbt_tuning(spark, d):
    """Area under the curve by the number of boosting rounds."""
    train, test = _split(_labelled(spark, d), "doc_id")
    points = [{"max_iter": n} for n in GBT_ROUNDS]
    return MD.classifier_grid(train, test, "gbt", points, {"maxIter": "max_iter"}, scratch_path(spark, "gbt-grid"))


@query("rf_grid", section="L10")
def q_rf_grid(spark, d):
    """Area under the curve over trees and depth of a random forest."""
    train, test = _split(_labelled(spark, d), "doc_id")
    points = [{"num_trees": t, "max_depth": p} for t, p in itertools.product(FOREST_TREES, FOREST_DEPTHS)]
    return MD.classifier_grid(train, test, "rf", points, {"numTrees": "num_trees", "maxDepth": "max_depth"}, scratch_path(spark, "rf-grid"))


@query("als_pairs_report", section="L17")
def q_als_report(spark, d):
    return MD.score_report(_als_scored_negatives(spark, d))


@query("glm_predict", section="L07")
def q_glm_predict(spark, d):
    ld = MD.doc_features(B.labelled_docs(spark, d))
    model, _ = MD.glm_summary(ld, "quality", MD.DOC_FEATURES, family="binomial", link="logit")
    docs = MD.assemble(MD.doc_features(RS(spark, d, "documents", "doc_id", "doc_id", "text")), MD.DOC_FEATURES)
    return model.transform(docs).select("doc_id", "prediction")


_WIDE_X = ("l_quantity", "l_discount", "l_tax")


def _wide_sql() -> str:
    """Three predictors by the inverse of their 3 x 3 matrix, from cofactors."""
    def c(i, j):
        a, b, d, e = [(p, q) for p in range(3) if p != i for q in range(3) if q != j]
        return f"((s{min(a)}{max(a)} * s{min(e)}{max(e)} - s{min(b)}{max(b)} * s{min(d)}{max(d)}) * {(-1) ** (i + j)})"
    names = [*_WIDE_X, "l_extendedprice"]
    sums = ", ".join(f"count(*) * covar_pop({names[i]}, {names[j]}) AS s{i}{j}" for i in range(4) for j in range(i, 4))
    means = ", ".join(f"avg({x}) AS m{i}" for i, x in enumerate(names))
    inv = ", ".join(f"{c(j, i)} / det AS i{i}{j}" for i in range(3) for j in range(3))
    beta = ", ".join(" + ".join(f"i{i}{j} * s{j}3" for j in range(3)) + f" AS b{i}" for i in range(3))
    fit = " + ".join(f"b{i} * s{i}3" for i in range(3))
    at = " + ".join(f"b{i} * m{i}" for i in range(3))
    spread = " + ".join(f"m{i} * i{i}{j} * m{j}" for i in range(3) for j in range(3))
    rows = " UNION ALL ".join([*[f"SELECT '{x}' AS term, b{i} AS b, sqrt(v * i{i}{i}) AS se, r2, dof FROM v" for i, x in enumerate(_WIDE_X)],
                               f"SELECT '(intercept)', m3 - ({at}), sqrt(v * (1.0 / n + {spread})), r2, dof FROM v"])
    p = Q.betainc("dof / 2.0", "0.5", "(dof / (dof + (b / se) * (b / se)))")
    return f"""WITH s AS (SELECT count(*) AS n, {sums}, {means} FROM lineitem),
 d AS (SELECT *, s00 * {c(0, 0)} + s01 * {c(0, 1)} + s02 * {c(0, 2)} AS det FROM s), i AS (SELECT *, {inv} FROM d), b AS (SELECT *, {beta} FROM i),
 v AS (SELECT *, (s33 - ({fit})) / (n - 4) AS v, ({fit}) / s33 AS r2, CAST(n - 4 AS BIGINT) AS dof FROM b), r AS ({rows})
SELECT term, {Q.sig('b', 6)} AS coefficient, {Q.sig('se', 6)} AS std_error, {Q.sig('b / se', 6)} AS t_value, round({p}, 6) AS p_value,
       round(r2, 9) AS r2, dof AS df_resid FROM r"""


@query("ols_multi", section="L04/L03", sql=_wide_sql())
def q_ols_multi(spark, d):
    out = ST.ols_wide(B.numeric(spark, d), "l_extendedprice", list(_WIDE_X))
    return out.select("term", *[sig(F.col(c), 6).alias(c) for c in ("coefficient", "std_error", "t_value")],
                      F.round("p_value", 6).alias("p_value"), F.round("r2", 9).alias("r2"), "df_resid")


@query("gbt_auc", section="L09")
def q_gbt(spark, d):
    train, test = _split(_labelled(spark, d), "doc_id")
    _, pred, auc = MD.fit_evaluate(train, test, "gbt", maxIter=5, maxDepth=3)
    exact = R.auc(pred.select(F.col("label"), MD.vector_to_array("probability")[1].alias("score")))
    return exact.select(F.lit("gbt").alias("model"), F.lit(auc).alias("evaluator_auc"), "auc")


@query("rf_auc", section="L10")
def q_rf(spark, d):
    train, test = _split(_labelled(spark, d), "doc_id")
    _, pred, auc = MD.fit_evaluate(train, test, "rf", numTrees=20, maxDepth=5)
    return pred.agg(F.lit("rf").alias("model"), F.lit(auc).alias("evaluator_auc"),
                    F.count(F.lit(1)).alias("n_test"))


@query("mlp_classifier", section="L22")
def q_mlp(spark, d):
    train, test = _split(_labelled(spark, d), "doc_id")
    _, pred, auc = MD.fit_evaluate(train, test, "mlp", layers=[len(MD.DOC_FEATURES), 5, 10, 2], maxIter=50)
    return pred.agg(F.lit("mlp").alias("model"), F.lit(auc).alias("evaluator_auc"),
                    F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))


@query("prob_export", section="L12")
def q_prob_export(spark, d):
    data = _labelled(spark, d)
    model = MD.classifier("gbt", maxIter=40).fit(data)
    docs = MD.assemble(MD.doc_features(RS(spark, d, "documents", "doc_id", "doc_id", "text")), MD.DOC_FEATURES)
    out = MD.probability_of_one(model.transform(docs), "doc_id")
    path = write_csv(out, scratch_path(spark, "prob-export"), mode="overwrite")
    return spark.read.csv(path, header=True, schema="doc_id bigint, predict double")


def _als_split(ui):
    b = hash_bucket(F.col("userId") + F.col("itemId"))
    return ui.filter(b < 70), ui.filter(b >= 70)


def _als_scored_negatives(spark, d):
    """The interactions, written once, are the training rows and what negatives are made of."""
    ui = B.user_item(spark, d, materialize=True)
    train, _ = _als_split(ui)
    model = MD.fit_als(train, rank=10, alpha=2.0, reg=2.0)
    n_items = B.item_names(spark, d).agg(F.max("itemId")).scalar()
    with sized_shuffles(spark, ui.count()):
        pairs = cut_lineage(R.hashed_negatives(ui, n_items))
    return MD.score_pairs(model, pairs)


@query("als_fit_predict", section="L14")
def q_als(spark, d):
    train, test = _als_split(B.user_item(spark, d, materialize=True))
    model = MD.fit_als(train, rank=10, alpha=2.0, reg=2.0)
    pred = model.transform(test)
    return pred.select("userId", "itemId", "count", "prediction")


@query("als_score_pairs", section="L17")
def q_als_pairs(spark, d):
    return _als_scored_negatives(spark, d).select("userId", "itemId", "prediction")


@query("als_grid_search", section="L15")
def q_als_grid(spark, d):
    """Mean AUC per user over rank, regularisation and confidence; all points read one
    training set, one test set and one set of negatives. Blocks and factors are kept on disk:
    the heap is for what the tasks of a fit hold."""
    train, test = _als_split(B.user_item(spark, d, materialize=True))
    n_items = B.item_names(spark, d).agg(F.max("itemId")).scalar()
    negatives = R.hashed_negatives(test, n_items).select("userId", "itemId", F.lit(0).alias("is_pos"))
    with sized_shuffles(spark, 2 * test.count()):
        pairs = cut_lineage(test.select("userId", "itemId", F.lit(1).alias("is_pos")).unionByName(negatives))
    train = cut_lineage(train)
    (at_once, blocks), rows = MD.als_side_by_side(train.count()), pairs.count()

    def fit(point):
        als = MD.als(rank=point["rank"], alpha=point["alpha"], reg=point["reg_param"]).setNumBlocks(blocks)
        model = als.setIntermediateStorageLevel("DISK_ONLY").setFinalStorageLevel("DISK_ONLY").fit(train)
        scored = model.transform(pairs).withColumnRenamed("prediction", "score")
        auc = R.mean_user_auc(scored, rows=rows).first()["mean_auc"]
        return {"mean_auc": None if auc is None else float(auc)}

    points = [{"rank": r, "reg_param": g, "alpha": a} for r, g, a in itertools.product((5, 10), (0.5, 2.0), (1.0, 2.0))]
    return run_grid(spark, points, fit, "reg_param double, alpha double, rank int, mean_auc double", scratch_path(spark, "als-grid"), at_once)


@query("negative_sampling", section="M04", sql=f"""
WITH ui AS {B.USER_ITEM_SQL},
 cand AS (SELECT itemId, row_number() OVER (ORDER BY itemId) - 1 AS place FROM (
   SELECT itemId FROM ui GROUP BY itemId ORDER BY count(*) DESC, itemId LIMIT 10000) x),
 size AS (SELECT count(*) AS size FROM cand),
 u AS (SELECT userId, itemId, count(*) OVER (PARTITION BY userId) AS npos, {Q.mixed_hash('CAST(userId AS BIGINT)', 0)} AS uh FROM ui),
 i AS (SELECT *, {Q.mixed_hash('uh + itemId', 1)} AS ih FROM u),
 h AS (SELECT userId, npos, d, {Q.mixed_hash('ih + d', 2)} * {Q.PRIME} + {Q.mixed_hash('ih + d', 3)} AS h FROM i, range(1, 17) r(d)),
 drawn AS (SELECT h.*, cand.itemId, size.size, ui.userId IS NULL AS fresh FROM h, size JOIN cand ON cand.place = h.h % size.size
   LEFT JOIN ui ON ui.userId = h.userId AND ui.itemId = cand.itemId),
 ranked AS (SELECT *, row_number() OVER w AS attempt, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER w AS kept FROM drawn
   WINDOW w AS (PARTITION BY userId ORDER BY d, h, itemId ROWS UNBOUNDED PRECEDING))
SELECT userId, itemId FROM ranked WHERE fresh AND kept <= npos AND attempt <= size""")
def q_negative_sampling(spark, d):
    ui = B.user_item(spark, d, materialize=True)
    cands = R.item_popularity(ui).orderBy(F.col("users").desc(), F.col("itemId")).limit(10_000).select("itemId")
    return MD.negative_sampling(ui, cands, seed=0)
