"""The permutation, the sequences, and fixed-stride shards."""

import time
from hashlib import sha256

import numpy as np
import pytest

from tablekit.llm import feistel_order as O
from tablekit.llm.runtime import SHUFFLE_CLEANUP, shared_dir


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation(n):
    f = O.Feistel(n, 11)
    slots = f.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert (f.numbers(slots) == np.arange(n)).all()
    if n == 4097:
        assert (O.Feistel(n, 12).slots(np.arange(n)) != slots).mean() > 0.9
        assert abs(np.corrcoef(slots, np.arange(n))[0, 1]) < 0.1


def collected(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: r["slot"])


def runs(rows, n_part_slots, order, length, width):
    """The parts' runs of ids, from the sequences in the order of their numbers."""
    by_number = sorted(rows, key=lambda r: int(order.numbers(np.array([r["slot"]]))[0]))
    return b"".join(bytes(r["ids"])[:r["n_ids"] * width] for r in by_number)


def test_sequences_hold_every_id_once(spark, docs, prose):
    texts = [None, "", "a", "b" * 15, "c" * 16, "d" * 17, prose(5000, 1)] + [prose(i, i) for i in range(1, 60)] + ["a"]
    rows = collected(O.byte_sequences(docs(texts, extra=True), length=16, shard_rows=50))
    assert [r["slot"] for r in rows] == list(range(len(rows)))
    assert all((r["shard"], r["place"]) == divmod(r["slot"], 50) and len(r["ids"]) == 16 for r in rows)
    assert all(bytes(r["ids"][r["n_ids"]:]) == b"\xfe" * (16 - r["n_ids"]) for r in rows)
    whole = runs(rows, None, O.Feistel(len(rows), 20), 16, 1)
    assert sorted(whole.split(b"\xff")[:-1]) == sorted((t or "").encode() for t in texts)
    # each document is named by the sequences that have its ids
    named = {}
    for r in rows:
        for k in r["keys"]:
            named.setdefault(k, []).append(r["slot"])
    assert sorted(named) == list(range(len(texts)))
    assert len(named[6]) in (-(-(len(texts[6]) + 1) // 16), -(-(len(texts[6]) + 1) // 16) + 1)


def test_slots_do_not_depend_on_the_number_of_partitions(spark, docs, prose):
    texts = [prose(i % 80, i) for i in range(150)] + [None] * 3
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (3, 8, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            seen.append([(r["slot"], bytes(r["ids"]), r["keys"]) for r in collected(O.byte_sequences(docs(texts).repartition(n), length=16, shard_rows=50))])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2]


def test_wide_ids_ties_and_empty_table(spark, docs):
    ids = np.arange(70_000, 70_010, dtype="<u4").tobytes()
    df = spark.createDataFrame([(1, bytearray(ids)), (1, bytearray(ids)), (None, None)], "doc_id bigint, ids binary")
    rows = collected(O.sequences(df, "doc_id", "ids", 4, 8, b"\x01\0\0\0", b"\0\0\0\0", 3, 2))
    assert sum(r["n_ids"] for r in rows) == 23 and sorted(r["n_ids"] for r in rows) in ([1, 6, 8, 8], [7, 8, 8])
    assert O.byte_sequences(docs([])).count() == 0


def test_shards_read_from_any_slot(spark, docs, prose):
    seqs = O.byte_sequences(docs([prose(i % 90, i) for i in range(200)]), length=32, shard_rows=64).cache()
    path = f"{shared_dir(spark)}/test-shards"
    got = collected(O.materialise(seqs, path, 32, 64))
    want = collected(seqs)
    assert [(r["slot"], r["shard"], r["place"], r["n_ids"], r["keys"]) for r in got] == [
        (r["slot"], r["shard"], r["place"], r["n_ids"], r["keys"]) for r in want]
    assert [r["sha256"] for r in got] == [sha256(bytes(r["ids"])).hexdigest() for r in want]
    for first, count in ((0, 5), (60, 10), (64, 200), (len(want) - 3, 3)):
        assert O.read_slots(path, first, count, 32, 64) == [bytes(r["ids"]) for r in want[first:first + count]]


def test_shuffles_go_with_the_write_that_made_them(spark, docs, prose):
    def shuffled():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName(): found.apply(i).length() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(SHUFFLE_CLEANUP)
    seqs = O.byte_sequences(docs([prose(i % 90, i) for i in range(600)]), length=16, shard_rows=20)
    got = O.materialise(seqs, f"{shared_dir(spark)}/test-passes", 16, 20)
    for _ in range(50):
        left = {k: n for k, n in shuffled().items() if k not in before}
        if sum(left.values()) < 20_000:
            break
        time.sleep(0.1)
    # the count of each part's sequences may be left; the sequences themselves are over 100 KB
    assert sum(left.values()) < 20_000
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
    rows = collected(got)
    assert [r["slot"] for r in rows] == list(range(seqs.count())) and len(rows) * 16 > 100_000


def test_a_pass_shuffles_its_own_sequences_only(spark, docs, prose):
    seqs = O.byte_sequences(docs([prose(i % 90, i) for i in range(300)]), length=16, shard_rows=20)
    plan = seqs.filter("shard % 3 = 1")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.index("Repartition") < plan.index("Filter")


def test_query_writes_token_ids(spark):
    import public_tokenizers
    import tiktoken
    from tablekit.llm import bpe_bitmap, queries
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe_bitmap.load_ranks(bpe_bitmap.tokenizer_file()))
    rows = collected(O.token_sequences(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))
    whole = np.frombuffer(runs(rows, None, O.Feistel(len(rows), 20), 512, 2), "<u2")
    ends = np.flatnonzero(whole == O.END)
    found = sorted(tuple(x.tolist()) for x in np.split(whole, ends + 1)[:-1])
    assert found == sorted((*enc.encode_ordinary(t), O.END) for t in docs.values())
    got = collected(queries.op6_feistel_order(spark, "/root/testdata/sf0.001"))
    assert [r["sha256"] for r in got] == [sha256(bytes(r["ids"])).hexdigest() for r in rows]
    assert {k for r in got for k in r["doc_ids"]} == set(docs)
