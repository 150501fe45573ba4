"""A training corpus from raw documents: five stages, each on all that the one
before has kept, written as Parquet in the shared folder between them.

Toxic documents go, then those that the word rules or their language's
perplexity band reject, then all but one document of each group of near copies;
the rest is put in the order of the source mix and encoded. All stages but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablekit.llm import bpe_bitmap, jaccard_multimatch, kn_perplexity, pfair_mix, toxic_grammar
from tablekit.llm.runtime import SLICE_BYTES, by_keys, written


def _rows(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar scores below one half."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = toxic_grammar.learn(docs, labels.filter(toxic_grammar.fold("doc_id", 5) != 0))
    return _rows(toxic_grammar.score(docs, model, below=0.5))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the word rules and lie in their perplexity band."""
    # the verdict is a text's and its language's: the rows wait in their table for the keys that go
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64("text", "lang", F.isnull("lang")).alias("key"))
    judged = kn_perplexity.judge(keyed.select("key", "row.text", "row.lang"), carry=["key"])
    gone = written(judged.filter("not kept").select("row.key").distinct(), "quality-gone")
    return _rows(by_keys(keyed, gone, "left_anti"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word Jaccard 0.8 the one with the
    smallest id (a null id only where no other is). Rows of one id and text are
    one document, of which the first by its columns' order stays; unlike texts of
    one id are documents of their own."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.xxhash64("doc_id", "text").alias("key"))
    groups = jaccard_multimatch.linked(rows.select("key", "row.text"), key="key", k=5, percent=80).distinct()
    members = rows.groupBy("key").agg(F.min("row.doc_id").alias("id"), F.count("*").alias("times"))
    members = written(groups.join(members, "key").select("key", "component_id", "id", "times"), "nd-members")
    best = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "key", "times")).alias("best")
    kept = written(members.groupBy("component_id").agg(best).select("best.key", "best.times"), "nd-kept")
    # decided on keys: the few that go are taken out, so most rows are never moved
    apart = written(members.select("key").join(kept.filter("times = 1"), "key", "left_anti"), "nd-apart")
    once = by_keys(rows, apart, "left_anti").select("row")
    often = written(kept.filter("times > 1").select("key"), "nd-often")
    # only documents that occur more than once are compared as rows
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("row")))
    more = by_keys(rows, often, "left_semi").withColumn("place", place).filter("place = 1").select("row")
    return _rows(once.union(more))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the Pfair schedule of their sources."""
    return _rows(pfair_mix.rows_in_order(docs))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and their decoding."""
    return bpe_bitmap.encode_column(docs, slice_bytes=SLICE_BYTES)


STAGES = [
    ("toxicity", toxicity),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("source mix", source_mix),
    ("encoding", encoding),
]

#: A language model, a trained grammar and a tokenizer have no SQL form; the
#: tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
