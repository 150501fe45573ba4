"""Each stage of the pipeline on what the one before kept, against plain Python."""

import os
import sys

import public_tokenizers
import pytest
import tiktoken

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as C  # noqa: E402
from tablekit.llm import bpe_bitmap, toxic_grammar  # noqa: E402
from tablekit.llm.runtime import written  # noqa: E402

from test_kn_perplexity import plain_band, plain_measures, plain_model  # noqa: E402
from test_near_duplicate_stage import brute  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    some = docs.limit(1).select(F.lit(None).cast("bigint").alias("doc_id"), "text", "lang", "source", "n_chars")
    blank = docs.orderBy("doc_id").limit(3).select((F.col("doc_id") + 10_000).alias("doc_id"), F.when(F.col("doc_id") % 2 == 0, "").alias("text"),
                                                   F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), "n_chars")
    docs = written(docs.union(some).union(blank).withColumn("score", F.lit(1)).withColumn("row", F.lit("x")), "pipeline-test")
    out = [("documents", docs)]
    for name, stage in C.STAGES:
        out.append((name, written(stage(spark, out[-1][1], SMOKE), "pipeline-test")))
    return out


def rows(df):
    return [r.asDict() for r in df.collect()]


def key(r):
    return (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "")


def test_columns_stay_and_rows_are_the_predecessors(stages):
    first = stages[0][1]
    for (_, before), (_, after) in zip(stages[:-2], stages[1:-1]):
        assert after.columns == first.columns
        have = [tuple(r) for r in before.collect()]
        assert all(tuple(r) in have for r in after.collect())
    assert 0 < stages[-1][1].count() == stages[-2][1].count()


def test_toxicity(spark, stages):
    docs = stages[0][1]
    labels = spark.read.parquet(f"{SMOKE}/labels.parquet")
    scorer = toxic_grammar.Scorer(toxic_grammar.learn(docs, labels.filter(toxic_grammar.fold("doc_id", 5) != 0)))
    want = [r for r in rows(docs) if scorer.score(r["text"] or "") < 0.5]
    assert sorted(rows(stages[1][1]), key=key) == sorted(want, key=key)
    bad = {r["doc_id"] for r in labels.filter("toxic = 1").collect()} & {r["doc_id"] for r in rows(docs)}
    assert len(bad - {r["doc_id"] for r in want}) > 0.5 * len(bad)


def test_quality_rules(stages):
    before = rows(stages[1][1])
    by_lang = {}
    for r in before:
        by_lang.setdefault(r["lang"], []).append(r)
    want = []
    for own in by_lang.values():
        log_ppl = plain_model([r["text"] or "" for r in own])
        ok = []
        for r in own:
            n, _, _, _, repeat = plain_measures(r["text"])
            if n >= 20 and 100 * repeat <= 30 * n:
                ok.append((log_ppl(r["text"]), r))
        if ok:
            low, high = plain_band([v for v, _ in ok])
            want += [r for v, r in ok if low <= v <= high]
    assert sorted(rows(stages[2][1]), key=key) == sorted(want, key=key)


def test_near_duplicates(stages):
    before = sorted(rows(stages[2][1]), key=key)
    groups = {}
    for r, (_, c) in zip(before, brute([r["text"] for r in before], 5, 80)):
        groups.setdefault(c, []).append(r)
    got = rows(stages[3][1])
    assert sorted(got, key=key) == sorted((min(g, key=key) for g in groups.values()), key=key)


def test_mix_keeps_all_and_encoding_matches(stages):
    before, mixed, last = rows(stages[3][1]), rows(stages[4][1]), rows(stages[5][1])
    assert sorted(mixed, key=key) == sorted(before, key=key)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe_bitmap.load_ranks(bpe_bitmap.tokenizer_file()))
    texts = {r["doc_id"]: r["text"] or "" for r in mixed}
    for r in last:
        assert r["n_tokens"] == len(enc.encode_ordinary(texts[r["doc_id"]]))


def test_run(spark):
    out = C.run(spark, SMOKE)
    assert 0 < out.count() <= 200 and "ids_sha256" in out.columns
