"""Steps whose tasks and traffic must not grow faster than the input."""

import glob
import threading

from pyspark.sql import functions as F

from tablekit import session as S
from tablekit.operators.sampling import random_split
from tablekit.plans import models as MD


def test_random_split_does_not_depend_on_partitions(spark):
    df = spark.range(5000).select((F.col("id") % 70).alias("userId"), F.col("id").alias("itemId"))
    one, two = (random_split(df.repartition(n), [0.7, 0.3], seed=0, key=["userId", "itemId"]) for n in (3, 7))
    sets = [[{tuple(r) for r in part.collect()} for part in parts] for parts in (one, two)]
    assert sets[0] == sets[1]
    train, test = sets[0]
    assert not train & test and len(train | test) == 5000 and 3300 < len(train) < 3700
    assert "Sort" not in one[0]._jdf.queryExecution().executedPlan().toString()


def test_shuffles_sized_by_rows_and_set_back(spark, monkeypatch):
    monkeypatch.setattr(S, "PARTITION_ROWS", 100)
    key = "spark.sql.shuffle.partitions"
    own = spark.conf.get(key)
    with S.sized_shuffles(spark, 50 * 100) as n:
        assert n == 50 == int(spark.conf.get(key))
    assert spark.conf.get(key) == own
    inside, leave = threading.Event(), threading.Event()

    def other():
        with S.sized_shuffles(spark, 90 * 100):
            inside.set()
            leave.wait(10)

    t = threading.Thread(target=other)
    with S.sized_shuffles(spark, 50 * 100):
        t.start()
        assert inside.wait(10)
    assert int(spark.conf.get(key)) == 90
    leave.set()
    t.join()
    assert spark.conf.get(key) == own


def test_users_with_their_items_draw_once(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(MD, "cut_lineage", _kept_in(spark, tmp_path))
    pos = spark.range(2000).select((F.col("id") % 100).cast("int").alias("userId"), (F.col("id") + 1_000_000).cast("int").alias("itemId"))
    cand = spark.range(500).select(F.col("id").cast("int").alias("itemId"))
    assert MD.negative_sampling(pos, cand).count() == 2000
    drawn = [spark.read.parquet(p) for p in glob.glob(f"{tmp_path}/*")]
    assert sum(d.count() for d in drawn if "_h" in d.columns) == 2000


def _kept_in(spark, folder):
    def keep(df):
        path = f"{folder}/{len(glob.glob(f'{folder}/*'))}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    return keep


def test_als_blocks_follow_the_rows():
    assert MD.als_blocks(0) == MD.als_blocks(100_000_000) == MD.BLOCKS
    assert MD.als_blocks(1_000_000_000) == 40


def test_fits_side_by_side_hold_so_many_rows():
    assert [MD.als_side_by_side(n) for n in (0, 25_000_000, 40_000_000, 150_000_000)] == [(4, 6), (4, 6), (2, 6), (1, 12)]
    for rows in (90_000_000, 300_000_000, 2_000_000_000):
        at_once, blocks = MD.als_side_by_side(rows)
        assert at_once == 1 and rows / blocks <= MD.GRID_BLOCK_ROWS


def test_large_fits_of_a_grid_run_one_by_one_and_keep_nothing_on_the_heap(spark, monkeypatch):
    from tablekit.plans.registry import load_all
    fit, plan, lock, running, seen = MD.ALS.fit, MD.als, threading.Lock(), [], []

    def watched(self, rows):
        with lock:
            running.append(self)
            seen.append((len(running), self.getIntermediateStorageLevel(), self.getFinalStorageLevel(), self.getNumUserBlocks(), self.getNumItemBlocks()))
        try:
            return fit(self, rows)
        finally:
            with lock:
                running.remove(self)

    monkeypatch.setattr(MD.ALS, "fit", watched)
    monkeypatch.setattr(MD, "als", lambda **point: plan(**point, max_iter=1))
    monkeypatch.setattr(MD, "GRID_ROWS", 1000, raising=False)
    monkeypatch.setattr(MD, "GRID_BLOCK_ROWS", 500, raising=False)
    rows = load_all()["als_grid_search"].build(spark, "/root/testdata/sf0.001").collect()
    assert len({(r["rank"], r["reg_param"], r["alpha"]) for r in rows}) == 8 and all(0 <= r["mean_auc"] <= 1 for r in rows)
    assert len(seen) == 8 and set(seen) == {(1, "DISK_ONLY", "DISK_ONLY", seen[0][3], seen[0][3])} and seen[0][3] > MD.BLOCKS


def test_unit_sums_send_a_part_each_vector_once(spark):
    from tablekit.plans.vectorplans import text_unit_sums
    texts = spark.range(400).select("id", F.array(*[F.concat(F.lit("w"), (F.col("id") + i) % 7) for i in range(30)]).alias("t"),
                                    F.when(F.col("id") > 0, F.array(F.lit("none"))).alias("s"))
    vectors = spark.range(7).select(F.concat(F.lit("w"), F.col("id")).alias("word"), F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("vec"))
    out = text_unit_sums(texts, "id", {"u": "t", "w": "s"}, vectors, 2)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan
    got = {r["id"]: (list(r["u"]), list(r["w"])) for r in out.collect()}
    assert len(got) == 400
    for i in (0, 5, 399):
        x, y = sum((i + k) % 7 for k in range(30)), 30.0
        size = (x * x + y * y) ** 0.5
        assert abs(got[i][0][0] - x / size) < 1e-12 and abs(got[i][0][1] - y / size) < 1e-12 and got[i][1] == [0.0, 0.0]


def test_lemmas_gather_only_changed_words(spark):
    from tablekit.operators.tokens import lemmatize
    from tablekit.plans.lexicon import lemma_table
    df = spark.createDataFrame([(1, ["dogs", "run", "dogs", "went"]), (2, []), (3, None), (4, ["plain"])], "id int, w array<string>")
    out = lemmatize(df, "id", "w", lemma_table(spark), name="l", keep_input=False)
    assert "posexplode" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r["id"]: r["l"] for r in out.collect()} == {1: ["dog", "run", "dog", "go"], 2: [], 3: [], 4: ["plain"]}


def test_glm_reads_costly_rows_once(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(MD, "cut_lineage", _kept_in(spark, tmp_path))
    df = spark.range(200).select(F.col("id").cast("double").alias("x"), (F.col("id") * 7 % 3 == 0).cast("int").alias("y"))
    MD.glm_summary(df, "y", ["x"])
    assert [spark.read.parquet(p).columns for p in glob.glob(f"{tmp_path}/*")] == [["features", "label"]]
