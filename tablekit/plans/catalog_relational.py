"""Registered relational queries (inventory P, J, A, O, U, M sections)."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bindings as B
from . import sqlfrag as Q
from .registry import query
from ..operators import aggregate as AG
from ..operators import joins as J
from ..operators import keyed as K
from ..operators import ordering as O
from ..operators import sampling as M
from ..operators import sets as U
from ..operators import shaping as S
from ..sources.tables import read_table as T

# ---------------------------------------------------------------- projection


@query("proj_select", section="P01", sql="""
SELECT l_orderkey AS order_id, l_linenumber AS line, l_quantity AS qty FROM lineitem""")
def q_proj_select(spark, d):
    return S.select_as(T(spark, d, "lineitem"), "l_orderkey as order_id",
                       "l_linenumber as line", "l_quantity as qty")


@query("proj_drop", section="P02", sql="SELECT c_custkey, c_name, c_nationkey FROM customer")
def q_proj_drop(spark, d):
    return S.drop_cols(T(spark, d, "customer"), "c_acctbal", "c_mktsegment")


@query("proj_derived", section="P03", sql="""
SELECT l_orderkey, l_linenumber,
       ROUND(l_extendedprice * (1 - l_discount), 4) AS revenue,
       CAST(l_quantity AS INTEGER) AS qty_int FROM lineitem""")
def q_proj_derived(spark, d):
    li = T(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice",
           "l_discount", "l_quantity")
    return S.with_derived(li, {
        "revenue": F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4),
        "qty_int": F.col("l_quantity").cast("int")}).select(
        "l_orderkey", "l_linenumber", "revenue", "qty_int")


@query("proj_literal", section="P04", sql="""
SELECT d.doc_id, -1 AS quality FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, quality FROM labels""")
def q_proj_literal(spark, d):
    docs = T(spark, d, "documents", "doc_id")
    lab = T(spark, d, "labels", "doc_id", "quality")
    unl = S.with_literal(docs.join(lab, "doc_id", "left_anti"), "quality", -1)
    return U.union_all(unl, lab)


@query("filter_range", section="P06", sql=f"""
SELECT event_id, user_id, event_type, value FROM {B.NULLABLE_SQL} e
 WHERE value > 10 AND value < 50 AND event_type <> 'click'""")
def q_filter_range(spark, d):
    e = B.nullable(spark, d)
    # NULL event types are dropped too: NULL <> 'click' is not true
    return e.filter((F.col("value") > 10) & (F.col("value") < 50) & (F.col("event_type") != "click"))


@query("filter_colcmp", section="P07", sql="""
SELECT l_orderkey, l_linenumber, l_tax, l_discount FROM lineitem WHERE l_tax > l_discount""")
def q_filter_colcmp(spark, d):
    return (T(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_tax", "l_discount")
            .where(F.col("l_tax") > F.col("l_discount")))


@query("filter_dropna", section="P08", sql=f"""
SELECT * FROM {B.NULLABLE_SQL} e WHERE event_id IS NOT NULL AND user_id IS NOT NULL
   AND event_type IS NOT NULL AND value IS NOT NULL""")
def q_filter_dropna(spark, d):
    return B.nullable(spark, d).dropna(how="any")


@query("flatmap_words", section="P09", sql=f"""
SELECT w AS word FROM (SELECT UNNEST(string_split_regex(line, ' ')) AS w FROM {B.TEXT_LINES_SQL} t) x
 WHERE w <> ''""")
def q_flatmap_words(spark, d):
    return S.flat_map_split(B.text_lines(spark, d), "line", " ", "word")


@query("filter_odd", section="P10", sql="""
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber % 2 <> 0""")
def q_filter_odd(spark, d):
    return (T(spark, d, "lineitem", "l_orderkey", "l_linenumber")
            .filter(F.col("l_linenumber") % 2 != 0))


@query("kv_keyby", section="P11", sql="""
SELECT upper(substr(c_name, 1, 1)) || CAST(c_nationkey AS VARCHAR) AS k, c_custkey, c_name FROM customer""")
def q_kv_keyby(spark, d):
    c = T(spark, d, "customer", "c_custkey", "c_name", "c_nationkey")
    key = F.concat(F.upper(F.substring("c_name", 1, 1)), F.col("c_nationkey").cast("string"))
    kb = S.key_by(c.select("c_custkey", "c_name", "c_nationkey"), key)
    return kb.select("k", "v.c_custkey", "v.c_name")


_CITY_SQL = """(SELECT c_name AS k, concat_ws('|', c_mktsegment, CAST(c_nationkey AS VARCHAR),
                 CAST(c_custkey AS VARCHAR)) AS v FROM customer)"""


def _city_like(spark, d):
    c = T(spark, d, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return c.select(F.col("c_name").alias("k"),
                    F.concat_ws("|", "c_mktsegment", "c_nationkey", "c_custkey").alias("v"))


@query("kv_mapvalues", section="P12", sql=f"""
SELECT k, string_split(v, '|') AS v FROM {_CITY_SQL} x""")
def q_kv_mapvalues(spark, d):
    return S.map_values(_city_like(spark, d), "v", lambda c: F.split(c, "\\|"))


@query("kv_flatmapvalues", section="P12", sql=f"""
SELECT k, UNNEST(string_split(v, '|')) AS v FROM {_CITY_SQL} x""")
def q_kv_flatmapvalues(spark, d):
    return S.flat_map_values(_city_like(spark, d), "v", lambda c: F.split(c, "\\|"))


@query("proj_indicator", section="P14", sql="""
SELECT o_orderkey, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS is_urgent FROM orders""")
def q_proj_indicator(spark, d):
    o = T(spark, d, "orders", "o_orderkey", "o_orderpriority")
    return o.select("o_orderkey", S.indicator("o_orderpriority", "1-URGENT").alias("is_urgent"))


@query("id_offset_union", section="P15", sql="""
SELECT doc_id AS id, quality FROM labels
UNION ALL
SELECT d.doc_id + (SELECT MAX(doc_id) FROM labels) + 1 AS id, -1 AS quality
  FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_id_offset_union(spark, d):
    train = T(spark, d, "labels", "doc_id", "quality").withColumnRenamed("doc_id", "id")
    test = (T(spark, d, "documents", "doc_id").join(T(spark, d, "labels", "doc_id"), "doc_id", "left_anti")
            .select(F.col("doc_id").alias("test_id"), F.lit(-1).alias("quality")))
    return S.id_offset_union(train, test, "id", "test_id")


@query("feat_polynomial", section="P17", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_quantity * l_quantity AS l_quantity_pow2 FROM lineitem""")
def q_feat_polynomial(spark, d):
    li = T(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    return S.polynomial(li, "l_quantity", 2)


@query("parse_delimited", section="P18", sql=f"""
SELECT CAST(string_split(line, chr(9))[1] AS BIGINT) AS custkey,
       string_split(line, chr(9))[2] AS name,
       CAST(string_split(line, chr(9))[3] AS INTEGER) AS nationkey FROM {B.DELIMITED_SQL} x""")
def q_parse_delimited(spark, d):
    return S.parse_delimited(B.delimited(spark, d), "line", "\t",
                             [("custkey", "bigint"), ("name", "string"), ("nationkey", "int")])


# --------------------------------------------------------------------- joins
_L, _R = B.LEFT_SQL, B.RIGHT_SQL


def _sides(spark, d):
    left = B.left_side(spark, d)
    right = B.right_side(spark, d).withColumnRenamed("o_custkey", "c_custkey")
    return left, right


@query("join_inner", section="J01", sql=f"""
SELECT l.c_custkey, l.c_name, r.o_orderkey FROM {_L} l JOIN {_R} r ON l.c_custkey = r.o_custkey""")
def q_join_inner(spark, d):
    return J.equi_join(*_sides(spark, d), "c_custkey", "inner")


@query("join_left", section="J02", sql=f"""
SELECT l.c_custkey, l.c_name, r.o_orderkey FROM {_L} l LEFT JOIN {_R} r ON l.c_custkey = r.o_custkey""")
def q_join_left(spark, d):
    return J.equi_join(*_sides(spark, d), "c_custkey", "left")


@query("join_right", section="J03", sql=f"""
SELECT r.o_custkey AS c_custkey, l.c_name, r.o_orderkey FROM {_L} l RIGHT JOIN {_R} r ON l.c_custkey = r.o_custkey""")
def q_join_right(spark, d):
    return J.equi_join(*_sides(spark, d), "c_custkey", "right")


@query("join_full", section="J04", sql=f"""
SELECT COALESCE(l.c_custkey, r.o_custkey) AS c_custkey, l.c_name, r.o_orderkey
  FROM {_L} l FULL JOIN {_R} r ON l.c_custkey = r.o_custkey""")
def q_join_full(spark, d):
    return J.equi_join(*_sides(spark, d), "c_custkey", "full")


@query("join_anti_message", section="J05/P19", sql=f"""
SELECT l.c_custkey, printf('customer %s has no urgent order', l.c_name) AS message
  FROM {_L} l WHERE NOT EXISTS (SELECT 1 FROM {_R} r WHERE r.o_custkey = l.c_custkey)""")
def q_join_anti(spark, d):
    left, right = _sides(spark, d)
    return (J.equi_join(left, right, "c_custkey", "anti")
            .select("c_custkey", F.format_string("customer %s has no urgent order", "c_name").alias("message")))


COGROUP_CHUNK = 4


@query("cogroup_lists", section="J06", sql=f"""
WITH ra AS (SELECT o_custkey AS custkey, o_orderkey AS v,
                   (ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // {COGROUP_CHUNK} AS chunk
              FROM orders WHERE o_orderpriority = '1-URGENT'),
     rb AS (SELECT o_custkey AS custkey, o_orderkey AS v,
                   (ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // {COGROUP_CHUNK} AS chunk
              FROM orders WHERE o_orderstatus = 'F'),
     a AS (SELECT custkey, chunk, list_sort(list(v)) AS left_values FROM ra GROUP BY custkey, chunk),
     b AS (SELECT custkey, chunk, list_sort(list(v)) AS right_values FROM rb GROUP BY custkey, chunk)
SELECT COALESCE(a.custkey, b.custkey) AS custkey, CAST(COALESCE(a.chunk, b.chunk) AS BIGINT) AS chunk,
       COALESCE(a.left_values, []::BIGINT[]) AS left_values,
       COALESCE(b.right_values, []::BIGINT[]) AS right_values
  FROM a FULL JOIN b ON a.custkey = b.custkey AND a.chunk = b.chunk""")
def q_cogroup(spark, d):
    o = T(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    left = o.filter(F.col("o_orderpriority") == "1-URGENT").withColumnRenamed("o_custkey", "custkey")
    right = o.filter(F.col("o_orderstatus") == "F").withColumnRenamed("o_custkey", "custkey")
    # chunks of 4 keep every row bounded; most customers have fewer orders
    # per side, several have more, so both shapes are exercised
    return J.cogroup(left, right, "custkey", "o_orderkey", "o_orderkey", chunk_size=COGROUP_CHUNK)


@query("agg_joinback", section="J08", sql=f"""
SELECT a.y, a.c, ROUND(m.group_mean, 4) AS group_mean
  FROM {B.ANOVA_SQL} a JOIN (SELECT c, AVG(y) AS group_mean FROM {B.ANOVA_SQL} x GROUP BY c) m ON a.c = m.c""")
def q_agg_joinback(spark, d):
    out = J.join_back_mean(B.anova_obs(spark, d), "c", "y")
    return out.select("y", "c", F.round("group_mean", 4).alias("group_mean"))


@query("join_broadcast_lookup", section="J09", sql="""
SELECT c.c_custkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_join_lookup(spark, d):
    c = T(spark, d, "customer", "c_custkey", "c_nationkey")
    # the nation table has a fixed 25 rows at every scale factor
    n = T(spark, d, "nation", "n_nationkey", "n_name").withColumnRenamed("n_nationkey", "c_nationkey")
    return J.lookup_join(c, n, "c_nationkey").select("c_custkey", "n_name")


# --------------------------------------------------------------- aggregation


@query("agg_count", section="A01", sql="SELECT COUNT(*) AS n FROM lineitem")
def q_agg_count(spark, d):
    return AG.count_rows(T(spark, d, "lineitem", "l_orderkey"))


@query("agg_group_count", section="A03", sql=f"""
SELECT user_id, COUNT(1) AS n_all, COUNT(event_type) AS n_typed FROM {B.NULLABLE_SQL} e GROUP BY user_id""")
def q_agg_group_count(spark, d):
    return (B.nullable(spark, d).groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n_all"), F.count("event_type").alias("n_typed")))


@query("agg_minmax", section="A04", sql="""
SELECT MIN(l_quantity) AS min_l_quantity, MAX(l_quantity) AS max_l_quantity,
       MIN(l_orderkey) AS min_l_orderkey, MAX(l_orderkey) AS max_l_orderkey FROM lineitem""")
def q_agg_minmax(spark, d):
    li = T(spark, d, "lineitem", "l_quantity", "l_orderkey")
    return AG.min_max(li, "l_quantity", "l_orderkey")


SQL_GROUP_STATS = """
SELECT c, SUM(y) AS sum_y, COUNT(*) AS n, AVG(y) AS mean_y FROM anova_obs GROUP BY c"""


@query("sql_group_stats", section="A05/S12", sql=f"""
SELECT c, ROUND(SUM(y), 2) AS sum_y, COUNT(*) AS n, ROUND(AVG(y), 4) AS mean_y
  FROM {B.ANOVA_SQL} a GROUP BY c""")
def q_sql_group_stats(spark, d):
    B.anova_obs(spark, d).createOrReplaceTempView("anova_obs")
    return spark.sql("""
        SELECT c, ROUND(SUM(y), 2) AS sum_y, COUNT(*) AS n, ROUND(AVG(y), 4) AS mean_y
          FROM anova_obs GROUP BY c""")


@query("wordcount", section="A06", sql=f"""
SELECT word, COUNT(*) AS n FROM (
  SELECT UNNEST(string_split_regex(line, '\\s+')) AS word FROM {B.TEXT_LINES_SQL} t) x
 WHERE word <> '' GROUP BY word""")
def q_wordcount(spark, d):
    words = S.flat_map_split(B.text_lines(spark, d), "line", "\\s+", "word")
    return K.word_count(words)


@query("kv_mean", section="A06", sql=f"""
SELECT k, ROUND(SUM(v), 4) AS total, COUNT(*) AS n, ROUND(SUM(v) / COUNT(*), 6) AS mean FROM {B.KV_SQL} x GROUP BY k""")
def q_kv_mean(spark, d):
    out = K.sum_count_mean(B.kv(spark, d))
    return out.select("k", F.round("total", 4).alias("total"), "n", F.round("mean", 6).alias("mean"))


@query("kv_group_mean", section="A07", sql=f"""
SELECT k, ROUND(AVG(v), 6) AS mean FROM {B.KV_SQL} x GROUP BY k""")
def q_kv_group_mean(spark, d):
    return B.kv(spark, d).groupBy("k").agg(F.round(F.avg("v"), 6).alias("mean"))


@query("kv_fold_max", section="A08", sql="""
SELECT l_linenumber AS k, GREATEST(0.0, MAX(l_quantity - 48.0)) AS folded FROM lineitem GROUP BY l_linenumber""")
def q_kv_fold_max(spark, d):
    li = T(spark, d, "lineitem", "l_linenumber", "l_quantity")
    kv = li.select(F.col("l_linenumber").alias("k"), (F.col("l_quantity") - 48.0).alias("v"))
    return K.fold_by_key_max(kv, 0.0)


@query("fold_sum", section="A09", sql="SELECT COALESCE(SUM(l_quantity), 0) AS total FROM lineitem")
def q_fold_sum(spark, d):
    return K.fold_sum(T(spark, d, "lineitem", "l_quantity"), "l_quantity")


@query("agg_by_expr", section="A10", sql="""
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS key, COUNT(*) AS n FROM orders GROUP BY 1""")
def q_agg_by_expr(spark, d):
    o = T(spark, d, "orders", "o_orderkey")
    return K.count_by(o, F.when(F.col("o_orderkey") % 2 == 0, "even").otherwise("odd"))


@query("distinct_rows", section="A12", sql="SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def q_distinct(spark, d):
    return T(spark, d, "lineitem", "l_returnflag", "l_linestatus").distinct()


@query("dedup_subset", section="A12", sql="""
SELECT c_nationkey, MIN(c_custkey) AS c_custkey, arg_min(c_name, c_custkey) AS c_name FROM customer GROUP BY c_nationkey""")
def q_dedup_subset(spark, d):
    c = T(spark, d, "customer", "c_custkey", "c_name", "c_nationkey")
    # survivor = smallest custkey per nation; min_by aggregates map-side
    return (c.groupBy("c_nationkey")
            .agg(F.min_by(F.struct("c_custkey", "c_name"), "c_custkey").alias("s"))
            .select("c_nationkey", "s.c_custkey", "s.c_name"))


@query("agg_count_distinct", section="A13", sql="""
SELECT COUNT(DISTINCT l_partkey) AS n_parts, COUNT(DISTINCT l_suppkey) AS n_suppliers,
       (SELECT COUNT(*) FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) x) AS n_pairs FROM lineitem""")
def q_count_distinct(spark, d):
    li = T(spark, d, "lineitem", "l_partkey", "l_suppkey")
    both = AG.count_distinct(li, "l_partkey", "l_suppkey", name="n_pairs").scalar()
    return li.agg(F.countDistinct("l_partkey").alias("n_parts"),
                  F.countDistinct("l_suppkey").alias("n_suppliers"), both.alias("n_pairs"))


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_numeric", section="A14", sql=" UNION ALL ".join(f"""
SELECT '{c}' AS "column", COUNT({c}) AS "count", ROUND(AVG({c}), 6) AS mean,
       ROUND(STDDEV_SAMP({c}), 6) AS stddev, CAST(MIN({c}) AS DOUBLE) AS "min", CAST(MAX({c}) AS DOUBLE) AS "max"
  FROM lineitem""" for c in _NUM))
def q_describe(spark, d):
    out = AG.describe_long(B.numeric(spark, d), _NUM)
    return out.select("column", "count", F.round("mean", 6).alias("mean"),
                      F.round("stddev", 6).alias("stddev"), "min", "max")


def _hist_sql(values_sql: str, col: str, bins: int = 10) -> str:
    return f"""
WITH v AS (SELECT CAST({col} AS DOUBLE) AS x FROM {values_sql} t WHERE {col} IS NOT NULL),
 b AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM v),
 c AS (SELECT CAST(CASE WHEN b.hi = b.lo THEN 0
                   ELSE LEAST(FLOOR((v.x - b.lo) / ((b.hi - b.lo) / {bins})), {bins - 1}) END AS INTEGER) AS bin,
              COUNT(*) AS n FROM v, b GROUP BY 1)
SELECT g.bin, ROUND(b.lo + g.bin * ((b.hi - b.lo) / {bins}), 6) AS lower,
       ROUND(b.lo + (g.bin + 1) * ((b.hi - b.lo) / {bins}), 6) AS upper, COALESCE(c.n, 0) AS n
  FROM (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) g CROSS JOIN b LEFT JOIN c ON g.bin = c.bin"""


@query("histogram_10", section="A16", sql=_hist_sql("lineitem", "l_extendedprice"))
def q_histogram(spark, d):
    h = AG.histogram(T(spark, d, "lineitem", "l_extendedprice"), "l_extendedprice", 10)
    return h.select("bin", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"), "n")


# ------------------------------------------------------------ sort and limit


@query("sort_desc", section="O01", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey""")
def q_sort_desc(spark, d):
    return O.sort_by(T(spark, d, "orders", "o_orderkey", "o_totalprice"),
                     F.col("o_totalprice").desc(), F.col("o_orderkey"))


@query("limit_n", section="O02", sql="""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 10""")
def q_limit_n(spark, d):
    return O.limit_n(T(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity"), 10,
                     "l_orderkey", "l_linenumber")


@query("topk", section="O03", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def q_topk(spark, d):
    return O.top_n(T(spark, d, "orders", "o_orderkey", "o_totalprice"), 10, "o_totalprice", "o_orderkey")


@query("topk_membership", section="O04", sql=f"""
WITH ui AS {B.USER_ITEM_SQL},
 top AS (SELECT itemId FROM (SELECT itemId, SUM("count") AS plays FROM ui GROUP BY itemId)
          ORDER BY plays DESC, itemId LIMIT 100)
SELECT userId, itemId, "count" FROM ui WHERE itemId IN (SELECT itemId FROM top)""")
def q_topk_membership(spark, d):
    ui = B.user_item(spark, d)
    pop = ui.groupBy("itemId").agg(F.sum("count").alias("plays"))
    return O.top_membership(ui, pop, 100, "itemId", "plays", "itemId")


# -------------------------------------------------------------------- sets


@query("set_union_all", section="U01/P16", sql="""
SELECT c_nationkey AS nationkey FROM customer UNION ALL SELECT s_nationkey AS nationkey FROM supplier""")
def q_union_all(spark, d):
    a = T(spark, d, "customer", "c_nationkey").withColumnRenamed("c_nationkey", "nationkey")
    b = T(spark, d, "supplier", "s_nationkey").withColumnRenamed("s_nationkey", "nationkey")
    return U.union_all(a, b)


def _lang_words_sql(lang):
    return f"""(SELECT DISTINCT w FROM (SELECT UNNEST(string_split_regex(text, '\\s+')) AS w
              FROM documents WHERE lang = '{lang}') x WHERE w <> '')"""


@query("set_intersect", section="U02", sql=f"""
SELECT upper(w) AS word FROM (SELECT w FROM {_lang_words_sql('en')} a INTERSECT SELECT w FROM {_lang_words_sql('fr')} b) i""")
def q_intersect(spark, d):
    docs = T(spark, d, "documents", "text", "lang")

    def words(lang):
        return S.flat_map_split(docs.filter(F.col("lang") == lang), "text", "\\s+", "w")
    return U.intersect_distinct(words("en"), words("fr")).select(F.upper("w").alias("word"))


@query("set_subtract_bag", section="U03", sql="""
SELECT l.l_partkey FROM lineitem l
 WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_size > 25 AND p.p_partkey = l.l_partkey)""")
def q_subtract_bag(spark, d):
    a = T(spark, d, "lineitem", "l_partkey")
    b = (T(spark, d, "part", "p_partkey", "p_size").filter(F.col("p_size") > 25)
         .select(F.col("p_partkey").alias("l_partkey")))
    return U.subtract_keep_duplicates(a, b)


# ---------------------------------------------------------------- sampling


_LINE_KEY = "l_orderkey * 8 + l_linenumber"


@query("sample_fraction", section="M01", sql=f"""
SELECT l_orderkey, l_linenumber FROM lineitem WHERE {Q.mixed_hash(_LINE_KEY, 42)} < {int(0.1 * M.PRIME)}""")
def q_sample_fraction(spark, d):
    return M.sample_fraction(T(spark, d, "lineitem", "l_orderkey", "l_linenumber"), 0.1, 42, F.expr(_LINE_KEY))


@query("sample_poisson", section="M01", sql=f"""
SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, {Q.mixed_hash(_LINE_KEY, 7)} AS h FROM lineitem) x,
       (VALUES {', '.join(f'({t})' for t in M.poisson_steps(0.5))}) s(t) WHERE h >= t""")
def q_sample_poisson(spark, d):
    return M.sample_fraction(T(spark, d, "lineitem", "l_orderkey", "l_linenumber"), 0.5, 7, F.expr(_LINE_KEY), with_replacement=True)


@query("sample_n_replace", section="M02", sql=f"""
WITH o AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS place, count(*) OVER () AS size FROM orders),
 d AS (SELECT r.range AS draw, {Q.mixed_hash('r.range', 42)} * {M.PRIME} + {Q.mixed_hash('r.range', 43)} AS h FROM range(1, 20001) r)
SELECT d.draw, o.o_orderkey, o.o_totalprice FROM d JOIN o ON o.place = d.h % o.size + 1""")
def q_sample_n_replace(spark, d):
    return M.sample_n_replace(T(spark, d, "orders", "o_orderkey", "o_totalprice"), 20_000, 42, "o_orderkey")


@query("sample_n", section="M02", sql=f"""
SELECT o_orderkey, o_totalprice FROM orders
 ORDER BY (((o_orderkey % {M.PRIME}) * {M.MULT} + 42) % {M.PRIME}) * {M.MULT} % {M.PRIME}, o_orderkey LIMIT 100""")
def q_sample_n(spark, d):
    return M.sample_n(T(spark, d, "orders", "o_orderkey", "o_totalprice"), 100, 42, "o_orderkey")


@query("split_hash", section="M03/M05", sql=f"""
SELECT userId, itemId, CASE WHEN ((CAST(userId AS BIGINT) * 7919) % 100) < 70 THEN 'train' ELSE 'test' END AS split
  FROM {B.USER_ITEM_SQL} ui""")
def q_split_hash(spark, d):
    ui = B.user_item(spark, d).select("userId", "itemId")
    train, test = M.hash_split(ui, "userId", 70)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query("split_random", section="M03/M05")
def q_split_random(spark, d):
    ui = B.user_item(spark, d, materialize=True).select("userId", "itemId")
    train, test = M.random_split(ui, [0.7, 0.3], seed=0, key=["userId", "itemId"])
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query("observe_metrics", section="A18", sql=f"""
SELECT COUNT(*) AS "rows", CAST(SUM(CASE WHEN event_type IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_event_type,
       CAST(SUM(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_value FROM {B.NULLABLE_SQL} e""")
def q_observe(spark, d):
    # observations attach a non-serializable manager to their session, which
    # breaks later ML closures that capture the session; use a child session
    child = spark.newSession()
    observed, obs = AG.observe_counts(B.nullable(child, d), "tk_metrics", ["event_type", "value"])
    observed.write.format("noop").mode("overwrite").save()  # metrics arrive with the action
    m = obs.get
    return spark.createDataFrame([(m["rows"], m["null_event_type"], m["null_value"])],
                                 "rows bigint, null_event_type bigint, null_value bigint")


_LI = ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
       "l_returnflag l_linestatus l_shipdate").split()


@query("schema_columns", section="P20", sql=f"""
WITH c AS (SELECT {', '.join(f'COUNT(*) - COUNT({x}) AS {x}' for x in _LI)} FROM lineitem),
 k AS (UNPIVOT c ON {', '.join(_LI)} INTO NAME column_name VALUE n_null)
SELECT CAST(list_position({_LI}, s.column_name) - 1 AS INTEGER) AS position, s.column_name AS name,
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
            WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS type,
       "null" = 'YES' AS nullable, k.n_null
  FROM (DESCRIBE lineitem) s JOIN k ON k.column_name = s.column_name""")
def q_schema(spark, d):
    return S.schema_table(T(spark, d, "lineitem", *_LI))
