"""Registered statistics queries (inventory L01-L04, L08, L11, L13, L21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bindings as B
from . import recommender as R
from . import statistics as ST
from .catalog_relational import _hist_sql
from .registry import query
from .sqlfrag import betainc
from .sqlfrag import sig as qsig
from ..functions.special import sig
from ..operators.aggregate import histogram
from ..sources.tables import read_table as T

_ANOVA_COLS = ["k", "n", "df_between", "df_within", "ss_between", "ss_within", "ms_between", "ms_within", "f"]
_ROUNDED = {"ss_between", "ss_within", "ms_between", "ms_within", "f"}


@query("anova_f", section="L01/A11/A15", sql=f"""
WITH g AS (SELECT c, COUNT(*) AS n, AVG(y) AS m FROM {B.ANOVA_SQL} a GROUP BY c),
 gm AS (SELECT AVG(y) AS gm FROM {B.ANOVA_SQL} a2),
 b AS (SELECT COUNT(*) AS k, SUM(n) AS n, SUM(n * pow(m - gm.gm, 2)) AS ssb FROM g, gm GROUP BY gm.gm),
 w AS (SELECT SUM(pow(a.y - g.m, 2)) AS ssw FROM {B.ANOVA_SQL} a JOIN g ON a.c = g.c)
SELECT k, CAST(n AS BIGINT) AS n, k - 1 AS df_between, CAST(n - k AS BIGINT) AS df_within,
       {qsig('ssb')} AS ss_between, {qsig('ssw')} AS ss_within,
       {qsig('ssb / (k - 1)')} AS ms_between, {qsig('ssw / (n - k)')} AS ms_within,
       {qsig('(ssb / (k - 1)) / (ssw / (n - k))')} AS f FROM b, w""")
def q_anova_f(spark, d):
    out = ST.anova_oneway(B.anova_obs(spark, d), "y", "c", with_p=False)
    return out.select(*[sig(c).alias(c) if c in _ROUNDED else F.col(c) for c in _ANOVA_COLS])


@query("anova_pvalue", section="L02", sql=f"""
WITH g AS (SELECT c, COUNT(*) AS n, AVG(y) AS m FROM {B.ANOVA_SQL} a GROUP BY c),
 gm AS (SELECT AVG(y) AS gm FROM {B.ANOVA_SQL} a2),
 b AS (SELECT COUNT(*) AS k, SUM(n) AS n, SUM(n * pow(m - gm.gm, 2)) AS ssb FROM g, gm GROUP BY gm.gm),
 w AS (SELECT SUM(pow(a.y - g.m, 2)) AS ssw FROM {B.ANOVA_SQL} a JOIN g ON a.c = g.c),
 f AS (SELECT k - 1 AS df_between, CAST(n - k AS BIGINT) AS df_within,
              (ssb / (k - 1)) / (ssw / (n - k)) AS f FROM b, w),
 t AS (SELECT df_between, df_within, f, df_within / 2.0 AS a, df_between / 2.0 AS bb,
              df_within / (df_within + df_between * f) AS x FROM f)
SELECT {qsig('f')} AS f, df_between, df_within, {qsig(betainc('a', 'bb', 'x'))} AS p_value FROM t""")
def q_anova_p(spark, d):
    out = ST.anova_oneway(B.anova_obs(spark, d), "y", "c")
    return out.select(sig("f").alias("f"), "df_between", "df_within", sig("p_value").alias("p_value"))


@query("ols_simple", section="L04", sql=f"""
WITH s AS (SELECT regr_count(l_extendedprice, l_quantity) AS n, regr_slope(l_extendedprice, l_quantity) AS slope,
                  regr_intercept(l_extendedprice, l_quantity) AS intercept, regr_r2(l_extendedprice, l_quantity) AS r2
             FROM lineitem)
SELECT CAST(n AS BIGINT) AS n, {qsig('slope', 8)} AS slope, {qsig('intercept', 8)} AS intercept,
       {qsig('r2', 6)} AS r2, CAST(n - 2 AS BIGINT) AS df_resid FROM s""")
def q_ols_simple(spark, d):
    s = ST.ols_simple(B.numeric(spark, d), "l_extendedprice", "l_quantity", with_p=False)
    return s.select("n", sig("slope", 8).alias("slope"), sig("intercept", 8).alias("intercept"),
                    sig("r2", 6).alias("r2"), "df_resid")


@query("ols_summary", section="L04", sql=f"""
WITH s AS (SELECT regr_count(l_extendedprice, l_quantity) AS n, regr_slope(l_extendedprice, l_quantity) AS slope,
                  regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_syy(l_extendedprice, l_quantity) AS syy
             FROM lineitem),
 e AS (SELECT n, slope, sqrt((syy - slope * slope * sxx) / (n - 2) / sxx) AS se FROM s),
 t AS (SELECT n, slope, se, slope / se AS t, (n - 2) / 2.0 AS a, 0.5 AS bb,
              (n - 2) / ((n - 2) + (slope / se) * (slope / se)) AS x FROM e)
SELECT CAST(n - 2 AS BIGINT) AS df_resid, {qsig('se', 8)} AS se_slope, {qsig('t', 8)} AS t_slope,
       {qsig(betainc('a', 'bb', 'x'), 8)} AS p_slope FROM t""")
def q_ols_summary(spark, d):
    s = ST.ols_simple(B.numeric(spark, d), "l_extendedprice", "l_quantity")
    return s.select("df_resid", sig("se_slope", 8).alias("se_slope"), sig("t_slope", 8).alias("t_slope"),
                    sig("p_slope", 8).alias("p_slope"))


_RESID_SQL = f"""(SELECT l_extendedprice - ({qsig('(SELECT regr_intercept(l_extendedprice, l_quantity) FROM lineitem)', 12)}
        + {qsig('(SELECT regr_slope(l_extendedprice, l_quantity) FROM lineitem)', 12)} * l_quantity) AS residual FROM lineitem)"""


@query("ols_residual_hist", section="L08", sql=_hist_sql(_RESID_SQL, "residual"))
def q_resid_hist(spark, d):
    res = ST.ols_residuals(B.numeric(spark, d), "l_extendedprice", "l_quantity")
    h = histogram(res, "residual", 10)
    return h.select("bin", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"), "n")


_SCALE = ["l_quantity", "l_discount"]


@query("scale_standard", section="L21", sql=f"""
SELECT l_orderkey, l_linenumber,
  {', '.join(f"round((CAST({c} AS DOUBLE) - {qsig(f'(SELECT AVG({c}) FROM lineitem)', 12)}) / {qsig(f'(SELECT STDDEV_POP({c}) FROM lineitem)', 12)}, 9) AS {c}" for c in _SCALE)}
FROM lineitem""")
def q_scale_standard(spark, d):
    li = T(spark, d, "lineitem", "l_orderkey", "l_linenumber", *_SCALE)
    out = ST.standard_scale(li, _SCALE)
    return out.select("l_orderkey", "l_linenumber", *[F.round(c, 9).alias(c) for c in _SCALE])


@query("scale_minmax", section="L21", sql=f"""
SELECT l_orderkey, l_linenumber,
  {', '.join(f"round(({c} - (SELECT MIN({c}) FROM lineitem)) / ((SELECT MAX({c}) FROM lineitem) - (SELECT MIN({c}) FROM lineitem)), 9) AS {c}" for c in _SCALE)}
FROM lineitem""")
def q_scale_minmax(spark, d):
    li = T(spark, d, "lineitem", "l_orderkey", "l_linenumber", *_SCALE)
    out = ST.minmax_scale(li, _SCALE)
    return out.select("l_orderkey", "l_linenumber", *[F.round(c, 9).alias(c) for c in _SCALE])


# deterministic stand-in probability per labelled document
def _prob(doc):
    return (F.pmod(F.col(doc) * 7919, F.lit(1000)) + 0.5) / 1000.0


_PROB_SQL = "((doc_id * 7919) % 1000 + 0.5) / 1000.0"


@query("log_loss", section="L13", sql=f"""
SELECT {qsig(f'AVG(-(quality * ln(least(greatest({_PROB_SQL}, 1e-15), 1 - 1e-15)) + (1 - quality) * ln(1 - least(greatest({_PROB_SQL}, 1e-15), 1 - 1e-15))))')} AS log_loss,
       COUNT(*) AS n FROM {B.LABELLED_SQL} l""")
def q_log_loss(spark, d):
    ld = B.labelled_docs(spark, d).withColumn("p", _prob("doc_id"))
    out = ST.log_loss(ld, "quality", "p")
    return out.select(sig("log_loss").alias("log_loss"), "n")


@query("auc_ranksum", section="L11", sql=f"""
WITH s AS (SELECT quality AS label, {_PROB_SQL} AS score FROM {B.LABELLED_SQL} l)
SELECT round(SUM(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0.0 END)
       / (COUNT(*)), 12) AS auc
  FROM s p JOIN s n ON p.label = 1 AND n.label = 0""")
def q_auc(spark, d):
    ld = B.labelled_docs(spark, d).select(F.col("quality").alias("label"), _prob("doc_id").alias("score"))
    return R.auc(ld, "score", "label").select(F.round("auc", 12).alias("auc"))
