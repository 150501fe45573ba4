"""Samples by hash, and least squares on many predictors."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablekit.operators import sampling as M
from tablekit.plans import statistics as ST


def frame(spark, n, parts):
    return spark.range(0, n, numPartitions=parts).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))


def test_fraction_is_the_same_for_any_partitions(spark):
    one = sorted(M.sample_fraction(frame(spark, 20_000, 3), 0.25, 5, "k").collect())
    assert one == sorted(M.sample_fraction(frame(spark, 20_000, 11), 0.25, 5, "k").collect())
    assert abs(len(one) - 5000) < 4 * math.sqrt(20_000 * 0.25 * 0.75) and len({r["k"] for r in one}) == len(one)
    assert one != sorted(M.sample_fraction(frame(spark, 20_000, 3), 0.25, 6, "k").collect())
    assert M.sample_fraction(frame(spark, 100, 1), 0.0, 1, "k").count() == 0
    assert M.sample_fraction(frame(spark, 100, 1), 1.0, 1, "k").count() == 100


@pytest.mark.parametrize("mean", [0.3, 1.0, 3.5])
def test_with_replacement_is_a_poisson_count(spark, mean):
    n = 20_000
    rows = M.sample_fraction(frame(spark, n, 5), mean, 3, "k", with_replacement=True)
    assert rows.columns == ["k", "v"]
    times = Counter(Counter(r["k"] for r in rows.collect()).values())
    times[0] = n - sum(times.values())
    for k in range(8):
        want = math.exp(-mean) * mean ** k / math.factorial(k)
        assert abs(times[k] / n - want) < 5 * math.sqrt(want * (1 - want) / n) + 1e-4


def test_draws_with_replacement(spark):
    df = frame(spark, 1000, 4)
    got = M.sample_n_replace(df, 5000, 9, "k").collect()
    assert sorted(r["draw"] for r in got) == list(range(1, 5001))
    again = M.sample_n_replace(frame(spark, 1000, 9), 5000, 9, "k").collect()
    assert sorted(got) == sorted(again)
    counts = Counter(r["k"] for r in got)
    assert all(r["v"] == r["k"] % 7 for r in got) and len(counts) > 950  # 1000 (1 - e^-5) = 993
    chi = sum((counts[k] - 5) ** 2 / 5 for k in range(1000))
    assert 800 < chi < 1250
    assert M.sample_n_replace(df.limit(0), 10, 9, "k").count() == 0


def plain_ols(x, y):
    a = np.column_stack([x, np.ones(len(x))])
    q, r = np.linalg.qr(a)
    inv = np.linalg.inv(r) @ np.linalg.inv(r).T
    b = np.linalg.solve(r, q.T @ y)
    rss = ((y - a @ b) ** 2).sum()
    se = np.sqrt(rss / (len(y) - a.shape[1]) * np.diag(inv))
    return b, se, 1 - rss / ((y - y.mean()) ** 2).sum()


def test_wide_least_squares(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(400, 12)) * 10.0 ** rnd.integers(-2, 3, 12) + rnd.normal(size=12) * 50
    y = x @ rnd.normal(size=12) + 7 + rnd.normal(size=400)
    names = [f"x{i}" for i in range(12)]
    df = spark.createDataFrame([tuple(map(float, [*r, v])) for r, v in zip(x, y)] + [(None,) * 13], ", ".join(f"{n} double" for n in [*names, "y"]))
    got = {r["term"]: r for r in ST.ols_wide(df, "y", names).collect()}
    b, se, r2 = plain_ols(x, y)
    for i, n in enumerate([*names, "(intercept)"]):
        assert got[n]["coefficient"] == pytest.approx(b[i], rel=1e-6) and got[n]["std_error"] == pytest.approx(se[i], rel=1e-6)
        assert got[n]["r2"] == pytest.approx(r2, rel=1e-9) and got[n]["df_resid"] == 387
    model = __import__("tablekit.plans.models", fromlist=["ols_multi"]).ols_multi(df.dropna(), "y", names).first()
    assert [got[n]["p_value"] for n in names] == pytest.approx(model["p_values"][:12], abs=1e-7)


def test_singular_design_and_few_rows_give_nulls(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, float(i * i)) for i in range(10)], "a double, b double, y double")
    assert all(r["coefficient"] is None and r["p_value"] is None for r in ST.ols_wide(df, "y", ["a", "b"]).collect())
    assert all(r["coefficient"] is None for r in ST.ols_wide(df.limit(0), "y", ["a"]).collect())
    exact = {r["term"]: r for r in ST.ols_wide(df.limit(2), "y", ["a"]).collect()}
    assert exact["a"]["coefficient"] == pytest.approx(1.0) and exact["a"]["t_value"] is None


def test_scaling_a_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    assert sorted(tuple(r) for r in ST.standard_scale(df, ["a", "c"]).collect()) == [(-1.0, None), (1.0, None)]
