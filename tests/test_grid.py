"""Grids of fits, and what holds at a fit."""

import threading

import pytest
from pyspark.sql import functions as F

from tablekit.plans import models as MD
from tablekit.plans.grid import point_path, run_grid
from tablekit.session import scratch_path
from tablekit.sources.sinks import path_exists

SCHEMA = "a int, b double, value double"
POINTS = [{"a": i, "b": i / 2} for i in range(6)]


def test_rows_land_and_a_second_run_fits_what_is_missing(spark):
    table, seen, lock = scratch_path(spark, "grid"), [], threading.Lock()

    def fit(point, broken=3):
        with lock:
            seen.append(point["a"])
        if point["a"] == broken:
            raise RuntimeError("lost")
        return {"value": spark.range(point["a"]).count() * 1.0}

    with pytest.raises(RuntimeError):
        run_grid(spark, POINTS, fit, SCHEMA, table, at_once=2)
    assert path_exists(spark, f"{point_path(table, POINTS[0])}/_SUCCESS")
    assert not path_exists(spark, f"{point_path(table, POINTS[3])}/_SUCCESS")
    seen.clear()
    got = run_grid(spark, POINTS, lambda p: fit(p, broken=None), SCHEMA, table).collect()
    assert sorted(tuple(r) for r in got) == [(i, i / 2, float(i)) for i in range(6)]
    assert 3 in seen and 0 not in seen
    seen.clear()
    assert run_grid(spark, POINTS, fit, SCHEMA, table).count() == 6 and seen == []


def test_score_equations_tell_a_fit_from_another_model(spark):
    rows = [(float(i % 5), float(i % 3), float((i * 7) % 4 > i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    model, _ = MD.glm_summary(df, "y", ["a", "b"], family="binomial", link="logit")
    fitted = model.transform(MD.assemble(df, ["a", "b"]))
    assert all(abs(r["score"]) < 1e-6 and r["n"] == 200 for r in MD.score_equations(fitted, "y", ["a", "b"], digits=9).collect())
    other = fitted.withColumn("prediction", F.col("prediction") * 0.9)
    assert any(abs(r["score"]) > 1e-3 for r in MD.score_equations(other, "y", ["a", "b"]).collect())


def test_factor_equations_tell_a_fit_from_other_factors(spark):
    ui = spark.createDataFrame([(u, i, (u * i) % 7 + 1) for u in range(30) for i in range(40) if (u * 3 + i * 5) % 4 == 0], "userId int, itemId int, count int")
    model = MD.fit_als(ui, rank=4, alpha=2.0, reg=0.5)
    good = MD.factor_equations(ui, model.userFactors, model.itemFactors, alpha=2.0, reg=0.5)
    assert good.count() == 30 and good.filter("solved").count() == 30
    bad = model.userFactors.withColumn("features", F.transform("features", lambda x: x * F.lit(1.05).cast("float")))
    assert MD.factor_equations(ui, bad, model.itemFactors, alpha=2.0, reg=0.5).filter("solved").count() == 0


def test_negatives_are_the_same_for_any_partitions_and_string_keys(spark):
    ui = spark.createDataFrame([(u, i) for u in range(20) for i in range(0, 60, u + 1)], "userId int, itemId int")
    cand = spark.range(60).select(F.col("id").cast("int").alias("itemId"))
    one = sorted(MD.negative_sampling(ui.repartition(2), cand, seed=4).collect())
    assert one == sorted(MD.negative_sampling(ui.repartition(7), cand, seed=4).collect())
    pos = {tuple(r) for r in ui.collect()}
    assert not pos & {tuple(r) for r in one}
    n = {u: sum(1 for r in one if r[0] == u) for u in range(20)}
    assert n[0] == 0 and all(n[u] == len(range(0, 60, u + 1)) for u in range(3, 20))
    names = ui.select(F.concat(F.lit("u"), "userId").alias("userId"), "itemId")
    assert MD.negative_sampling(names, cand, seed=4).groupBy("userId").count().count() >= 17


def test_a_forest_keeps_its_rows_nodes_and_has_the_same_trees(spark):
    rows = spark.range(600).select(F.array([F.pmod(F.xxhash64("id", F.lit(i)), F.lit(50)).cast("double") for i in range(4)]).alias("x"))
    rows = rows.withColumn("label", (F.pmod(F.col("x")[0] * 3 + F.col("x")[1], F.lit(7)) < 3).cast("double"))
    train = MD.assemble(rows.select("label", *[F.col("x")[i].alias(f"x{i}") for i in range(4)]), [f"x{i}" for i in range(4)]).coalesce(1)
    forest = MD.classifier("rf", numTrees=8, maxDepth=12)
    assert forest.getCacheNodeIds()
    one, two = (f.fit(train).toDebugString.split("\n", 1)[1] for f in (forest, forest.copy({forest.cacheNodeIds: False})))
    assert one == two and one.count("If") > 100
