"""The registered queries: each applies an operator to its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe_bitmap, edit_counts, feistel_order, html_style_tree, jaccard_multimatch, kn_perplexity, lsa_knn,
               pfair_mix, runtime, spelling_trie, spotsigs, toxic_grammar, turn_repair, url_boost)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_style_tree.extract(table(spark, sf_dir, "pages"))


def op2_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = pfair_mix.mixed(table(spark, sf_dir, "documents"), carry=["doc_id", "source"])
    return placed.select("row.*", "size", "stream", "block", "slot", "offset")


def op3_kn_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = kn_perplexity.judge(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return judged.select("row.doc_id", *kn_perplexity.MEASURES, "base_failed", "kept", "lang", "n_units",
                         "log_ppl", "low", "high")


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def op5_toxic_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxic_grammar.learn(docs, labels.filter(toxic_grammar.fold("doc_id", 5) != 0))
    scored = toxic_grammar.score(docs, model, carry=["doc_id"]).select("row.doc_id", "score")
    return scored.select("doc_id", (toxic_grammar.fold("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_feistel_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = feistel_order.token_sequences(table(spark, sf_dir, "documents"), length=512, shard_rows=4096)
    path = f"{runtime.shared_dir(spark)}/shards-{uuid.uuid4().hex[:12]}"
    return feistel_order.materialise(seqs, path, 1024, 4096).withColumnRenamed("keys", "doc_ids")


def op7_bpe_rank_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_bitmap.encode_column(table(spark, sf_dir, "documents"), with_ids=False)


def op8_lsa_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = toxic_grammar.fold("doc_id", 4) == 2
    scored = lsa_knn.score(docs, lsa_knn.learn(docs, labels.filter(~held)))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_jaccard_multimatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_multimatch.linked(table(spark, sf_dir, "documents"))


def op10_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = runtime.written(edit_counts.plant(table(spark, sf_dir, "documents")), "edit-trees")
    return edit_counts.recount(trees.withColumn("edits", edit_counts.sample_edits()))


def op11_frequency_vector_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    runs = spelling_trie.word_runs(docs, least=7, carry=["doc_id"])
    run = F.col("run")
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run))
    word = F.when(h % 31 == 0, spelling_trie.without_letter(run, h % F.length(run))).otherwise(run)
    words = runs.select(word.alias("word")).filter(F.length("word") >= 7)
    return spelling_trie.variants(spelling_trie.count_words(words, least=2), ratio=10)


def op12_rank_convergence_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")

    def given(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(given("conv_id"), F.lit(":"), given("turn"))) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(given("text"), "[.!?]", "")).otherwise(given("text"))
    damaged = turns.select("conv_id", "turn", F.when(fate == 4, "user").otherwise(given("role")).alias("role"), text.alias("text"),
                           F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("times"))
    return turn_repair.repair(damaged, times="times")


#: (verdict, host, path)
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op13_url_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_boost.judge(table(spark, sf_dir, "pages"), URL_RULES)


QUERIES = {f.__name__: f for f in (
    op1_site_style_tree,
    op2_pfair_mix,
    op3_kn_perplexity,
    op4_spotsigs,
    op5_toxic_grammar,
    op6_feistel_order,
    op7_bpe_rank_queue,
    op8_lsa_knn,
    op9_jaccard_multimatch,
    op10_edit_counts,
    op11_frequency_vector_trie,
    op12_rank_convergence_viterbi,
    op13_url_boost,
)}

#: Shingle sets, links and reachability as SQL.
OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh
  FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.g = y.g AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id AS v, doc_id AS c FROM s UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.v)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, m.c AS component_id
FROM s JOIN (SELECT v, min(c) AS c FROM r GROUP BY v) m ON m.v = s.doc_id
"""

ORACLES: dict[str, str] = {
    "op9_jaccard_multimatch": OP9_SQL,
}
