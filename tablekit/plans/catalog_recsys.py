"""Registered recommender queries (inventory L14-L20, A02, A17, M04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bindings as B
from . import recommender as R
from .registry import query

UI, NAMES = B.USER_ITEM_SQL, B.ITEM_NAMES_SQL


@query("top_items", section="L18", sql=f"""
SELECT p.itemId, CAST(p.plays AS BIGINT) AS plays, p.users, n.name
  FROM (SELECT itemId, SUM("count") AS plays, COUNT(userId) AS users FROM {UI} ui GROUP BY itemId) p
  JOIN {NAMES} n ON p.itemId = n.itemId
 ORDER BY p.users DESC, p.itemId LIMIT 20""")
def q_top_items(spark, d):
    return R.top_items(B.user_item(spark, d), B.item_names(spark, d), 20)


@query("top_users", section="L19", sql=f"""
SELECT userId, CAST(SUM("count") AS BIGINT) AS plays, COUNT(itemId) AS items
  FROM {UI} ui GROUP BY userId ORDER BY plays DESC, userId LIMIT 10""")
def q_top_users(spark, d):
    return R.top_users(B.user_item(spark, d), 10)


@query("agg_item_popularity", section="A02/P05", sql=f"""
SELECT itemId, CAST(SUM("count") AS BIGINT) AS plays, COUNT(userId) AS users FROM {UI} ui GROUP BY itemId""")
def q_item_pop(spark, d):
    return R.item_popularity(B.user_item(spark, d))


@query("agg_user_activity", section="A02", sql=f"""
SELECT userId, CAST(SUM("count") AS BIGINT) AS plays, COUNT(itemId) AS items FROM {UI} ui GROUP BY userId""")
def q_user_act(spark, d):
    return R.user_activity(B.user_item(spark, d))


CLEAN = dict(min_items=30, max_items=60, min_users=25)


@query("clean_interactions", section="L20", sql=f"""
WITH ui AS {UI}, names AS {NAMES},
 u AS (SELECT userId FROM ui GROUP BY userId HAVING COUNT(itemId) > {CLEAN['min_items']} AND COUNT(itemId) < {CLEAN['max_items']}),
 i AS (SELECT itemId FROM ui GROUP BY itemId HAVING COUNT(userId) > {CLEAN['min_users']})
SELECT ui.userId, ui.itemId, ui."count" FROM ui
 WHERE ui.userId IN (SELECT userId FROM u)
   AND ui.itemId IN (SELECT itemId FROM i)
   AND ui.itemId IN (SELECT itemId FROM names WHERE name <> '[unknown]')""")
def q_clean(spark, d):
    return R.clean_interactions(B.user_item(spark, d, materialize=True), B.item_names(spark, d), **CLEAN)


@query("interaction_sparsity", section="A17", sql=f"""
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT userId) AS n_users, COUNT(DISTINCT itemId) AS n_items_seen,
       (SELECT COUNT(DISTINCT itemId) FROM {NAMES} c) AS n_items_catalogue,
       ROUND(COUNT(*) / (COUNT(DISTINCT userId) * (SELECT COUNT(DISTINCT itemId) FROM {NAMES} c2)), 12) AS sparsity
  FROM {UI} ui""")
def q_sparsity(spark, d):
    out = R.sparsity(B.user_item(spark, d), B.item_names(spark, d))
    return out.withColumn("sparsity", F.round("sparsity", 12))


def _scored(spark, d):
    ui = B.user_item(spark, d, materialize=True)
    n_items = B.item_names(spark, d).agg(F.max("itemId")).scalar()
    pos = ui.select("userId", "itemId", F.lit(1).alias("is_pos"))
    neg = R.hashed_negatives(ui, n_items).withColumn("is_pos", F.lit(0))
    return pos.unionByName(neg).withColumn("score", R.hashed_score()), 2 * ui.count()


SCORED_SQL = f"""
WITH ui AS {UI},
 mx AS (SELECT MAX(itemId) AS m FROM {NAMES} n),
 cand AS (SELECT DISTINCT ui.userId,
                 CAST(((CAST(ui.itemId AS BIGINT) * 31 + CAST(ui.userId AS BIGINT) * 17) % mx.m) + 1 AS INTEGER) AS itemId
            FROM ui, mx),
 neg AS (SELECT c.userId, c.itemId FROM cand c
          WHERE NOT EXISTS (SELECT 1 FROM ui p WHERE p.userId = c.userId AND p.itemId = c.itemId)),
 scored AS (
   SELECT userId, itemId, 1 AS is_pos FROM ui
   UNION ALL SELECT userId, itemId, 0 AS is_pos FROM neg),
 s AS (SELECT userId, itemId, is_pos,
              ((CAST(itemId AS BIGINT) * 7919 + CAST(userId AS BIGINT) * 104729) % 1000) / 1000.0 AS score
         FROM scored)"""


@query("mean_user_auc", section="L16/J11", sql=SCORED_SQL + """
, per_user AS (
   SELECT p.userId,
          SUM((SELECT COUNT(*) FROM s n WHERE n.userId = p.userId AND n.is_pos = 0 AND n.score < p.score)) AS correct,
          COUNT(*) AS n_pos,
          (SELECT COUNT(*) FROM s n WHERE n.userId = p.userId AND n.is_pos = 0) AS n_neg
     FROM s p WHERE p.is_pos = 1 GROUP BY p.userId)
SELECT ROUND(AVG(CASE WHEN n_pos * n_neg > 0 THEN correct / (n_pos * n_neg) END), 9) AS mean_auc,
       CAST(COUNT(CASE WHEN n_pos * n_neg > 0 THEN 1 END) AS BIGINT) AS n_users
  FROM per_user""")
def q_mean_user_auc(spark, d):
    scored, rows = _scored(spark, d)
    out = R.mean_user_auc(scored, rows=rows)
    return out.select(F.round("mean_auc", 9).alias("mean_auc"), "n_users")
