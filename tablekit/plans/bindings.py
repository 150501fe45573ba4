"""Stand-ins for the reference's inputs, built from the driver's tables.

Each binding has a Spark form ``fn(spark, data_dir)`` and a SQL form (a
parenthesised sub-select over the pre-registered views) used by the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_spread, read_table
from ..operators.ordering import dense_index
from ..session import cut_lineage, sized_shuffles

# The catalogue name the cleaning step excludes, and the
# catalogue name that stands for it in the part table.
UNKNOWN_NAME = "[unknown]"
UNKNOWN_STAND_IN = "blue anvil"


def user_item(spark: SparkSession, d: str, materialize: bool = False) -> DataFrame:
    """Interactions ``(userId int, itemId int, count bigint)``: quantity bought
    per customer and part. ``materialize`` checkpoints it for plans that
    read it several times."""
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    od = read_table(spark, d, "orders", "o_orderkey", "o_custkey")
    if materialize:
        with sized_shuffles(spark, li.count()):
            return cut_lineage(user_item(spark, d))
    return (li.join(od, li.l_orderkey == od.o_orderkey)
              .groupBy("o_custkey", "l_partkey")
              .agg(F.sum("l_quantity").cast("bigint").alias("count"))
              .select(F.col("o_custkey").cast("int").alias("userId"),
                      F.col("l_partkey").cast("int").alias("itemId"), "count"))


USER_ITEM_SQL = """(SELECT CAST(o.o_custkey AS INTEGER) AS userId,
        CAST(l.l_partkey AS INTEGER) AS itemId,
        CAST(SUM(l.l_quantity) AS BIGINT) AS "count"
   FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey, l.l_partkey)"""


def item_names(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "part", "p_partkey", "p_name")
    return p.select(F.col("p_partkey").cast("int").alias("itemId"),
                    F.when(F.col("p_name") == UNKNOWN_STAND_IN, F.lit(UNKNOWN_NAME))
                     .otherwise(F.col("p_name")).alias("name"))


ITEM_NAMES_SQL = f"""(SELECT CAST(p_partkey AS INTEGER) AS itemId,
        CASE WHEN p_name = '{UNKNOWN_STAND_IN}' THEN '{UNKNOWN_NAME}' ELSE p_name END AS name
   FROM part)"""


def anova_obs(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "orders", "o_totalprice", "o_orderpriority").select(
        F.col("o_totalprice").alias("y"), F.col("o_orderpriority").alias("c"))


ANOVA_SQL = "(SELECT o_totalprice AS y, o_orderpriority AS c FROM orders)"


def pairs(spark: SparkSession, d: str, materialize: bool = True) -> DataFrame:
    """Consecutive turns of a conversation as a text pair, with a dense id in
    ``(conv_id, turn)`` order starting at 0. ``materialize`` writes it for
    plans that read it several times."""
    c = read_table(spark, d, "conversations", "conv_id", "turn", "text")
    a, b = c.alias("a"), c.alias("b")
    joined = a.join(b, (F.col("a.conv_id") == F.col("b.conv_id"))
                    & (F.col("b.turn") == F.col("a.turn") + 1)).select(
        F.col("a.conv_id").alias("conv_id"), F.col("a.turn").alias("turn"),
        F.col("a.text").alias("question1"), F.col("b.text").alias("question2"))
    out = dense_index(joined, ["conv_id", "turn"], name="id", start=0).select("id", "question1", "question2")
    return cut_lineage(out) if materialize else out


PAIRS_SQL = """(SELECT CAST(ROW_NUMBER() OVER (ORDER BY a.conv_id, a.turn) - 1 AS BIGINT) AS id,
        a.text AS question1, b.text AS question2
   FROM conversations a JOIN conversations b
     ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""


def labelled_docs(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents", "doc_id", "text")
    lab = read_table(spark, d, "labels", "doc_id", "quality")
    return docs.join(lab, "doc_id")


LABELLED_SQL = """(SELECT d.doc_id, d.text, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def text_lines(spark: SparkSession, d: str) -> DataFrame:
    docs = read_spread(spark, d, "documents", "doc_id", "doc_id", "text")
    return docs.select(F.explode(F.split("text", "\n")).alias("line"))


TEXT_LINES_SQL = "(SELECT UNNEST(string_split(text, chr(10))) AS line FROM documents)"


def kv(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "lineitem", "l_returnflag", "l_quantity").select(
        F.col("l_returnflag").alias("k"), F.col("l_quantity").alias("v"))


KV_SQL = "(SELECT l_returnflag AS k, l_quantity AS v FROM lineitem)"


def left_side(spark: SparkSession, d: str) -> DataFrame:
    """Customers of one market segment (some have no urgent order)."""
    return (read_table(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment")
            .filter(F.col("c_mktsegment") == "BUILDING").drop("c_mktsegment"))


LEFT_SQL = "(SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING')"


def right_side(spark: SparkSession, d: str) -> DataFrame:
    """Urgent orders (some from customers of other segments)."""
    return (read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
            .filter(F.col("o_orderpriority") == "1-URGENT").drop("o_orderpriority"))


RIGHT_SQL = "(SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')"


def numeric(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "lineitem", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


def delimited(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer", "c_custkey", "c_name", "c_nationkey")
    return c.select(F.concat_ws("\t", "c_custkey", "c_name", "c_nationkey").alias("line"))


DELIMITED_SQL = """(SELECT concat_ws(chr(9), CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR)) AS line FROM customer)"""


def nullable(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events", "event_id", "user_id", "event_type", "value")
    return e.withColumn("event_type", F.expr("nullif(event_type, 'error')"))


NULLABLE_SQL = "(SELECT event_id, user_id, nullif(event_type, 'error') AS event_type, value FROM events)"


def activity(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events", "user_id", "event_type")
    return e.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


ACTIVITY_SQL = "(SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY user_id, event_type)"


def vectors(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "embeddings", "vec_id", "embedding", "label")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"), "label")


VECTORS_SQL = "(SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings)"
