"""Plan-shape guards over every registered query."""

import io
import contextlib

import __spark_entry__ as E

from test_contract import FITTING

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_no_cross_joins_or_python_udfs(spark):
    bad = {}
    for key, fn in E.queries().items():
        if key in FITTING or key == "pipeline" or key.startswith("op"):  # fits, and the corpus operators
            continue
        plan = _plan(fn(spark, "/root/testdata/sf0.001"))
        hits = [f for f in FORBIDDEN if f in plan]
        if hits:
            bad[key] = hits
    assert not bad, bad


def test_scans_are_pruned(spark):
    # a narrow query reads only the columns it needs
    plan = _plan(E.queries()["filter_colcmp"](spark, "/root/testdata/sf0.001"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_discount:double,l_tax:double>" in plan
    plan = _plan(E.queries()["join_inner"](spark, "/root/testdata/sf0.001"))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)" in plan


def test_bucket_bounds_sample_has_no_single_task_topk(spark):
    from pyspark.sql import functions as F
    from tablekit.operators import ordering as O
    df = spark.range(0, 5000, numPartitions=4).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    q = spark.range(1).select(O._bounds(df, ["a", "b"], 16, 8).alias("x"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    plan = buf.getvalue()
    assert "TakeOrderedAndProject" not in plan
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) and final
    bounds = q.first().x
    assert len(bounds) == 15 and bounds == sorted(bounds)


def test_lookup_join_broadcasts_by_measured_size_only(spark):
    from pyspark.sql import functions as F
    from tablekit.operators import joins as J
    try:
        big = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
        look = spark.range(0, 50).select(F.col("id").alias("k"), F.lit("x").alias("name"))

        def plan(df):
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                df.explain()
            return buf.getvalue()
        assert "BroadcastHashJoin" in plan(J.lookup_join(big, look, "k"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "BroadcastHashJoin" not in plan(J.lookup_join(big, look, "k"))
        assert J.lookup_join(big, look, "k").count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
