"""Registered queries on fitted models whose rows SQL can state: what must hold
at the fit of each table's data (inventory L05-L07, L09, L10, L12, L14, L17, L22),
and small sources and projections (S07, P13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bindings as B
from . import models as MD
from . import recommender as R
from .catalog_models import _als_split, _labelled, _split
from .registry import query
from ..operators.shaping import keys, values
from ..session import cut_lineage
from ..sources.files import rows_source
from ..sources.tables import read_spread as RS
from ..sources.tables import read_table as T

_PRIORITIES = ((1, "1-URGENT"), (2, "2-HIGH"), (3, "3-MEDIUM"))


@query("src_rows", section="S07", sql=f"""
SELECT v.rank, count(*) AS n FROM orders JOIN (VALUES {', '.join(f"({k}, '{p}')" for k, p in _PRIORITIES)}) v(rank, name)
    ON o_orderpriority = v.name GROUP BY v.rank""")
def q_rows(spark, d):
    names = rows_source(spark, list(_PRIORITIES), "rank int, name string")
    orders = T(spark, d, "orders", "o_orderpriority")
    return orders.join(names, orders.o_orderpriority == names.name).groupBy("rank").agg(F.count(F.lit(1)).alias("n"))


@query("kv_keys_values", section="P13", sql=f"""
SELECT 'key' AS part, k AS item, count(*) AS n FROM {B.KV_SQL} x GROUP BY k
UNION ALL SELECT 'value', CAST(CAST(v AS INTEGER) AS VARCHAR), count(*) FROM {B.KV_SQL} x GROUP BY v""")
def q_keys_values(spark, d):
    kv = B.kv(spark, d)
    k = keys(kv, "k").select(F.lit("key").alias("part"), F.col("k").alias("item"))
    v = values(kv, "v").select(F.lit("value").alias("part"), F.col("v").cast("int").cast("string").alias("item"))
    return k.unionByName(v).groupBy("part", "item").agg(F.count(F.lit(1)).alias("n"))


def _zeros(names) -> str:
    return "SELECT unnest([" + ", ".join(f"'{n}'" for n in names) + "]) AS term, CAST(0 AS DOUBLE) AS score, {n} AS n"


@query("glm_logistic_scores", section="L05/L07", sql=_zeros([*MD.DOC_FEATURES, "(intercept)"]).format(
    n="(SELECT count(*) FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"))
def q_logistic_scores(spark, d):
    """At the maximum of the likelihood every predictor's score, the sum of x (y - mu), is 0."""
    rows = cut_lineage(MD.doc_features(B.labelled_docs(spark, d)))
    model, _ = MD.glm_summary(rows, "quality", MD.DOC_FEATURES, family="binomial", link="logit")
    return MD.score_equations(model.transform(MD.assemble(rows, MD.DOC_FEATURES)), "quality", MD.DOC_FEATURES)


_EVENTS = ("click", "view", "purchase", "signup")


@query("glm_poisson_scores", section="L06/L07", sql=_zeros([*[f"is_{t}" for t in _EVENTS], "(intercept)"]).format(
    n=f"(SELECT count(*) FROM {B.ACTIVITY_SQL} a)"))
def q_poisson_scores(spark, d):
    act = B.activity(spark, d)
    names = [f"is_{t}" for t in _EVENTS]
    rows = cut_lineage(act.withColumns({f"is_{t}": F.coalesce(F.col("event_type") == t, F.lit(False)).cast("double") for t in _EVENTS}))
    model, _ = MD.glm_summary(rows, "n", names, family="poisson", link="log")
    return MD.score_equations(model.transform(MD.assemble(rows, names)).withColumnRenamed("n", "y"), "y", names)


@query("prob_export_report", section="L12", sql="""
SELECT count(*) AS n, CAST(0 AS BIGINT) AS outside, true AS repeats FROM documents""")
def q_prob_report(spark, d):
    """Probabilities of every document, in [0, 1]; equal features give equal ones."""
    model = MD.classifier("gbt", maxIter=10).fit(_labelled(spark, d))
    docs = MD.assemble(MD.doc_features(RS(spark, d, "documents", "doc_id", "doc_id", "text")), MD.DOC_FEATURES)
    pred = model.transform(docs).select("doc_id", "features", MD.vector_to_array("probability")[1].alias("p"))
    out = cut_lineage(pred.select("doc_id", F.xxhash64(MD.vector_to_array("features")).alias("x"), F.round("p", 6).alias("predict")))
    same = out.groupBy("x").agg((F.min("predict") == F.max("predict")).alias("same")).agg(F.every("same")).scalar()
    return out.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~F.col("predict").between(0, 1), 1)).alias("outside"), same.alias("repeats"))


@query("tree_auc_agreement", section="L09/L10/L11", sql="""
SELECT unnest(['gbt', 'rf']) AS model, true AS agrees, (SELECT count(*) FROM labels l JOIN documents d ON d.doc_id = l.doc_id
        WHERE (l.doc_id * 7919) % 100 >= 70) AS n_test""")
def q_tree_auc(spark, d):
    """The evaluator's area under the curve is the share of rightly ordered pairs, ties half."""
    train, test = (cut_lineage(x) for x in _split(_labelled(spark, d), "doc_id"))
    out = None
    for kind, params in (("gbt", {"maxIter": 5, "maxDepth": 3}), ("rf", {"numTrees": 20, "maxDepth": 5})):
        _, pred, area = MD.fit_evaluate(train, test, kind, **params)
        pred = cut_lineage(pred.select("label", F.get(MD.vector_to_array("rawPrediction"), 1).alias("score")))
        exact = R.auc(pred)
        one = exact.select(F.lit(kind).alias("model"), F.coalesce(F.abs(F.col("auc") - F.lit(area)) < 1e-9, F.lit(False)).alias("agrees"),
                           pred.agg(F.count(F.lit(1))).scalar().alias("n_test"))
        out = one if out is None else out.unionByName(one)
    return out


@query("mlp_report", section="L22", sql="""
SELECT count(*) AS n_test, true AS sums_to_one, true AS predicts_larger FROM labels l JOIN documents d ON d.doc_id = l.doc_id
 WHERE (l.doc_id * 7919) % 100 >= 70""")
def q_mlp_report(spark, d):
    """Class probabilities add up to one, and the prediction is the larger one."""
    train, test = (cut_lineage(x) for x in _split(_labelled(spark, d), "doc_id"))
    _, pred, _ = MD.fit_evaluate(train, test, "mlp", layers=[len(MD.DOC_FEATURES), 5, 10, 2], maxIter=20)
    p = MD.vector_to_array("probability")
    return pred.agg(F.count(F.lit(1)).alias("n_test"), F.every(F.abs(p[0] + p[1] - 1) < 1e-9).alias("sums_to_one"),
                    F.every((F.col("prediction") == 1) == (p[1] > p[0])).alias("predicts_larger"))


_TRAIN_SQL = f"(SELECT * FROM {B.USER_ITEM_SQL} ui WHERE ((CAST(userId AS BIGINT) + itemId) * 7919) % 100 < 70)"


@query("als_factor_equations", section="L14", sql=f"SELECT DISTINCT userId, true AS solved FROM {_TRAIN_SQL} t")
def q_als_equations(spark, d):
    """Each user's factors solve the regularised least squares that the items' factors pose."""
    train, _ = _als_split(B.user_item(spark, d, materialize=True))
    train = cut_lineage(train)
    model = MD.fit_als(train, rank=5, alpha=2.0, reg=0.5)
    return MD.factor_equations(train, cut_lineage(model.userFactors), cut_lineage(model.itemFactors), alpha=2.0, reg=0.5)


@query("als_pairs_scores", section="L17", sql=f"""
WITH t AS {_TRAIN_SQL}, p AS (SELECT DISTINCT userId, itemId FROM {B.USER_ITEM_SQL} ui)
SELECT userId, itemId, userId IN (SELECT userId FROM t) AND itemId IN (SELECT itemId FROM t) AS known, true AS agrees FROM p""")
def q_als_scores(spark, d):
    """A score is the product of both sides' factors, NaN where one side is unknown."""
    ui = B.user_item(spark, d, materialize=True)
    train, _ = _als_split(ui)
    model = MD.fit_als(train, rank=5, alpha=2.0, reg=0.5)
    scored = MD.score_pairs(model, ui.select("userId", "itemId"))
    users, items = (cut_lineage(x.select(F.col("id"), F.col("features").cast("array<double>"))) for x in (model.userFactors, model.itemFactors))
    rows = scored.join(users.toDF("userId", "u"), "userId", "left").join(items.toDF("itemId", "v"), "itemId", "left")
    dot = F.aggregate(F.zip_with("u", "v", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    known = F.col("u").isNotNull() & F.col("v").isNotNull()
    return rows.select("userId", "itemId", known.alias("known"),
                       F.when(known, F.abs(F.col("prediction") - dot) < 1e-4 * (1 + F.abs(dot))).otherwise(F.isnan("prediction")).alias("agrees"))
