"""Aggregation operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

_FN = {"sum": F.sum, "count": F.count, "avg": F.avg, "mean": F.avg, "max": F.max,
       "min": F.min}


def group_agg(df: DataFrame, keys: list[str], spec: dict[str, str],
              names: dict[str, str] | None = None) -> DataFrame:
    """Dict-style ``agg({"count": "sum", "userId": "count"})`` with the
    outputs renamed in the same step (default names ``sum(count)``)."""
    names = names or {}
    cols = [_FN[fn](F.col(c)).alias(names.get(c, f"{fn}({c})")) for c, fn in spec.items()]
    return df.groupBy(*keys).agg(*cols)


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def min_max(df: DataFrame, *cols: str) -> DataFrame:
    """``min_<c>`` and ``max_<c>`` of each column in one pass."""
    return df.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))])


def count_distinct(df: DataFrame, *cols: str, exact: bool = True, name: str = "n_distinct") -> DataFrame:
    """Distinct combinations of ``cols`` without a NULL among them."""
    if exact:
        return df.agg(F.countDistinct(*cols).alias(name))
    whole = F.when(F.coalesce(*[F.when(F.col(c).isNull(), True) for c in cols], F.lit(False)), None)
    return df.agg(F.approx_count_distinct(whole.otherwise(F.struct(*cols))).alias(name))


def describe_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """``describe()`` in long form: one row per column with count, mean,
    sample stddev, min and max — a single aggregation pass."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"),
                 F.stddev_samp(c).alias(f"{c}__stddev"), F.min(c).cast("double").alias(f"{c}__min"),
                 F.max(c).cast("double").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stack = ", ".join(
        f"'{c}', `{c}__count`, `{c}__mean`, `{c}__stddev`, `{c}__min`, `{c}__max`" for c in cols)
    return wide.selectExpr(
        f"stack({len(cols)}, {stack}) as (column, count, mean, stddev, min, max)")


def histogram(df: DataFrame, value: str | Column, bins: int = 10) -> DataFrame:
    """Equal-width histogram between min and max, last bin closed on the
    right (``numpy``/``plt.hist`` convention). Empty bins are kept. Bounds
    are scalar subqueries; the bin table has ``bins`` rows (broadcast)."""
    v = F.col(value) if isinstance(value, str) else value
    vals = df.select(v.cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    # one scalar subquery (a struct) for both bounds: one scan, reused
    b = vals.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))).scalar()
    lo, hi = b["lo"], b["hi"]
    width = (hi - lo) / F.lit(bins)
    idx = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - lo) / width), F.lit(bins - 1))).cast("int")
    counts = vals.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (F.broadcast(grid).join(counts, "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("lower"),
                    (lo + (F.col("bin") + 1) * width).alias("upper"),
                    F.coalesce("n", F.lit(0)).alias("n")))


def observe_counts(df: DataFrame, name: str, null_cols: list[str] = ()):
    """Run-time counters without a separate job: returns the observed frame
    and an ``Observation`` filled after the first action. Observing attaches
    a manager to the session that ML model closures cannot serialize; run
    observed jobs in ``spark.newSession()`` when the session also fits models."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.sum(F.col(c).isNull().cast("long")).alias(f"null_{c}") for c in null_cols]
    return df.observe(obs, *metrics), obs
