"""Registered source/sink round trips (inventory S01-S13). Each writes to a
fresh path under the session's shared checkpoint folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bindings as B
from .registry import query
from ..operators.ordering import dense_index
from ..operators.shaping import id_offset_union
from ..session import scratch_path
from ..sources import files as SRC
from ..sources.csv_records import numbered_lines
from ..sources import sinks as SNK
from ..sources.tables import read_table as T


@query("src_text_lines", section="S01/S09", sql=f"""
SELECT CAST(length(line) AS INTEGER) AS len, COUNT(*) AS n FROM {B.TEXT_LINES_SQL} t GROUP BY 1""")
def q_text_lines(spark, d):
    docs = T(spark, d, "documents", "text")
    path = SNK.write_text(docs, scratch_path(spark, "text-lines"), "text")
    lines = SRC.read_lines(spark, f"{path}/*.txt")
    return lines.groupBy(F.length("value").alias("len")).agg(F.count(F.lit(1)).alias("n"))


@query("src_whole_files", section="S02", sql="""
SELECT source, CAST(SUM(length(text) + 1) AS BIGINT) AS n_chars FROM documents GROUP BY source""")
def q_whole_files(spark, d):
    docs = T(spark, d, "documents", "doc_id", "text", "source")
    path = scratch_path(spark, "whole-files")
    docs.select("source", "text").write.partitionBy("source").text(path)
    files = SRC.read_whole_files(spark, f"{path}/*/*.txt")
    # one file per (source, partition): total characters per source (each
    # written line ends with a newline)
    return (files.select(F.regexp_extract("path", "source=([^/]+)", 1).alias("source"),
                         F.length("content").alias("n"))
            .groupBy("source").agg(F.sum("n").alias("n_chars")))


_DOC_SCHEMA = "doc_id bigint, text string, lang string"


@query("src_csv_schema", section="S03", sql="SELECT doc_id, text, lang FROM documents")
def q_csv_schema(spark, d):
    docs = T(spark, d, "documents", "doc_id", "text", "lang")
    path = SNK.write_csv(docs, scratch_path(spark, "csv-schema"), header=True)
    return SRC.read_csv_typed(spark, path, _DOC_SCHEMA, header=True, multi_line=True)


@query("src_csv_infer", section="S04", sql="""
SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem""")
def q_csv_infer(spark, d):
    li = T(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    path = SNK.write_csv(li, scratch_path(spark, "csv-infer"), header=True)
    return SRC.read_csv_inferred(spark, path)


@query("src_csv_strings", section="S05", sql="""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey_raw, c_custkey, c_name, c_acctbal FROM customer""")
def q_csv_strings(spark, d):
    c = T(spark, d, "customer", "c_custkey", "c_name", "c_acctbal")
    path = SNK.write_csv(c, scratch_path(spark, "csv-strings"), header=True)
    typed = SRC.read_csv_strings(spark, path, casts={"c_custkey": "bigint", "c_acctbal": "double"},
                                 keep_raw=True)
    return typed.select("c_custkey_raw", "c_custkey", "c_name", "c_acctbal")


@query("src_range", section="S06", sql="""
SELECT r.range AS id FROM range((SELECT MIN(l_partkey) FROM lineitem), (SELECT MAX(l_partkey) FROM lineitem) + 1) r
 WHERE r.range NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)""")
def q_range(spark, d):
    li = T(spark, d, "lineitem", "l_partkey", "l_quantity")
    # two scalars to the driver to size the generated range
    bounds = li.agg(F.min("l_partkey").alias("lo"), F.max("l_partkey").alias("hi")).first()
    ids = SRC.range_source(spark, bounds["lo"], bounds["hi"] + 1)
    big = li.filter(F.col("l_quantity") > 45)
    return ids.join(big, ids.id == big.l_partkey, "left_anti")


@query("sink_csv_roundtrip", section="S08/S11", sql=f"""
SELECT itemId, CAST(SUM("count") AS BIGINT) AS plays, COUNT(userId) AS users FROM {B.USER_ITEM_SQL} ui GROUP BY itemId""")
def q_csv_roundtrip(spark, d):
    from .recommender import item_popularity
    pop = item_popularity(B.user_item(spark, d))
    tab = SNK.write_csv(pop, scratch_path(spark, "csv-tab"), sep="\t", header=False, quote="")
    back = spark.read.csv(tab, sep="\t", schema="itemId int, plays bigint, users bigint")
    one = SNK.write_csv(back, scratch_path(spark, "csv-header"), mode="overwrite")
    return spark.read.csv(one, header=True, schema="itemId int, plays bigint, users bigint")


@query("sink_single_csv", section="S08", sql=f"""
SELECT row_number() OVER (ORDER BY itemId) AS line, itemId, plays, users FROM (
  SELECT itemId, CAST(SUM("count") AS BIGINT) AS plays, COUNT(userId) AS users FROM {B.USER_ITEM_SQL} ui GROUP BY itemId) x""")
def q_single_csv(spark, d):
    """One file with one header, in order: the place of each line is read back too."""
    from .recommender import item_popularity
    path = SNK.write_csv(item_popularity(B.user_item(spark, d)), scratch_path(spark, "single.csv"), single_file=True, order=["itemId"])
    lines = dense_index(numbered_lines(spark, path), ["block", "line"], name="number", start=0)
    return lines.filter(F.col("number") > 0).select(
        F.col("number").alias("line"), F.from_csv("value", "itemId int, plays bigint, users bigint").alias("r")).select("line", "r.*")


@query("sink_parquet_keyed", section="S10", sql=f"""
SELECT userId, itemId, "count" FROM {B.USER_ITEM_SQL} ui""")
def q_parquet_keyed(spark, d):
    ui = B.user_item(spark, d)
    path = SNK.write_keyed_parquet(ui, scratch_path(spark, "keyed"), "userId", buckets=16)
    return spark.read.parquet(path).drop("bucket")


@query("export_split_rebased", section="S13", sql="""
SELECT d.doc_id AS id, -1 AS quality FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_export_split(spark, d):
    train = T(spark, d, "labels", "doc_id", "quality").withColumnRenamed("doc_id", "id")
    test = (T(spark, d, "documents", "doc_id").join(T(spark, d, "labels", "doc_id"), "doc_id", "left_anti")
            .select(F.col("doc_id").alias("test_id"), F.lit(-1).alias("quality")))
    combined = id_offset_union(train, test, "id", "test_id")
    max_train = train.agg(F.max("id")).scalar()
    _, test_back = SNK.export_split_rebased(combined, "id", max_train)
    path = SNK.write_csv(test_back, scratch_path(spark, "export-test"), header=True)
    return spark.read.csv(path, header=True, schema="id bigint, quality int")
