"""Sorting, limits, top-k, and distributed ordered scans.

``ordered_scan`` replaces the two patterns that otherwise collapse a whole
table into one task: ``row_number()`` over a global order and running sums
over a global order. Rows go to range buckets of the sort key (boundaries
from a bounded sample, so once rows are unique on the key no value can own
a whole bucket), local positions and sums are computed per bucket, and each
bucket's offset comes from a table with one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def _cols(cols):
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def desc(col: str) -> Column:
    """Descending key for ordered scans (numeric columns): ``-col``."""
    return F.negative(F.col(col))


def _keys(order) -> list[Column]:
    """Ordered-scan keys must be plain ascending expressions (they go into a
    struct for bucket search); use ``desc(col)`` for descending numerics."""
    return _cols(order)


def sort_by(df: DataFrame, *cols, ascending: bool | list[bool] = True) -> DataFrame:
    """Total sort; pass a unique tiebreak column last for a repeatable order."""
    return df.orderBy(*cols, ascending=ascending)


def limit_n(df: DataFrame, n: int, *order) -> DataFrame:
    """``take(n)``: first ``n`` rows of a total order (TakeOrderedAndProject)."""
    return df.orderBy(*_cols(order)).limit(n)


def top_n(df: DataFrame, n: int, key: str | Column, *tiebreak) -> DataFrame:
    """``top(n, key)``: the ``n`` largest by ``key`` (then tiebreak ascending)."""
    k = F.col(key) if isinstance(key, str) else key
    return df.orderBy(k.desc(), *_cols(tiebreak)).limit(n)


def top_membership(df: DataFrame, candidates: DataFrame, n: int, key: str,
                   score: str, tiebreak: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among the top ``n`` of ``candidates`` by
    ``score``. The top set is bounded by ``n``, so it is broadcast."""
    order = [F.col(score).desc()] + ([F.col(tiebreak)] if tiebreak else [F.col(key)])
    top = candidates.orderBy(*order).limit(n).select(key)
    return df.join(F.broadcast(top), key, "left_semi")


def _bounds(df: DataFrame, order: list, n: int, sample_per_bucket: int) -> Column:
    order_cols = _keys(order)
    # stratified hash sample: rows go to n hash groups, and each group keeps
    # its sample_per_bucket smallest hashes. A row_number filter becomes a
    # map-side partial group limit, so every task ships at most that many
    # rows per group and the merge is spread over n reducers (a global top-k
    # would funnel tasks x k rows through one task). Repeated keys share a
    # hash, so a hot key costs one group at most sample_per_bucket rows.
    h = F.xxhash64(*order_cols)
    rows = df.select(F.struct(*order_cols).alias("_key"), h.alias("_h"))
    by_group = Window.partitionBy(F.pmod(F.col("_h"), F.lit(n))).orderBy("_h", "_key")
    sample = (rows.withColumn("_r", F.row_number().over(by_group))
                  .filter(F.col("_r") <= sample_per_bucket))
    return sample.agg(F.sort_array(F.collect_list("_key")).alias("_s")).select(
        F.expr(f"transform(sequence(1, {n - 1}), i -> try_element_at(_s, greatest(1, "
               f"cast(i * size(_s) / {n} as int))))").alias("_b")).scalar()


def with_range_bucket(df: DataFrame, order: list, n: int, name: str = "_bkt",
                      sample_per_bucket: int = 64) -> DataFrame:
    """Deterministic range-bucket number in ``[0, n)`` for the sort key.

    Boundaries come from a bounded, deterministic sample (per hash group of
    the key, the ``sample_per_bucket`` smallest hashes: one pass, bounded
    memory, no single-task merge of per-task samples) and are a scalar
    subquery, so every evaluation of the plan assigns the same bucket to the
    same row. The bucket is a binary search over the boundaries
    (``log2(n)`` comparisons per row). An empty input has no boundaries.
    """
    if n <= 1:
        return df.withColumn(name, F.lit(0))
    key = F.struct(*_keys(order))
    bounds = F.col("_bounds")
    steps = max(1, (n - 1).bit_length() + 1)
    # state: (lo, hi) over bucket positions; bucket = number of bounds < key
    search = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        F.struct(F.lit(0).alias("lo"), F.lit(n - 1).alias("hi")),
        lambda s, _: F.when(
            s["lo"] >= s["hi"], s).otherwise(
            F.when(F.element_at(bounds, ((s["lo"] + s["hi"]) / 2).cast("int") + 1) < key,
                   F.struct((((s["lo"] + s["hi"]) / 2).cast("int") + 1).alias("lo"), s["hi"].alias("hi")))
             .otherwise(F.struct(s["lo"].alias("lo"), ((s["lo"] + s["hi"]) / 2).cast("int").alias("hi")))))
    return (df.withColumn("_bounds", _bounds(df, order, n, sample_per_bucket))
              .withColumn(name, search["lo"]).drop("_bounds"))


def ordered_scan(df: DataFrame, order: list, sums: list[str] = (),
                 index_col: str | None = "_index", num_buckets: int | None = None,
                 inclusive: bool = True) -> DataFrame:
    """Add the global 1-based position (``index_col``) and running sums
    ``_cum_<c>`` of ``sums`` in the order of ``order`` (must be a total order
    for a repeatable result). ``inclusive=False`` gives sums of the rows
    strictly before each row.
    """
    spark = df.sparkSession
    n = num_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_cols = _keys(order)
    # range-partitioning on the bucket id puts each bucket in its own task
    # (hashing small integers collides) and satisfies the window's clustering
    bucketed = cut_lineage(with_range_bucket(df, order, n)).repartitionByRange(n, "_bkt")
    frame = Window.partitionBy("_bkt").orderBy(*order_cols)
    run = frame.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = bucketed.select(
        "*",
        *([F.row_number().over(frame).alias("_lpos")] if index_col else []),
        *[F.sum(c).over(run).alias(f"_lcum_{c}") for c in sums])
    # one row per bucket: bounded by the bucket count, broadcast is safe
    totals = bucketed.groupBy("_bkt").agg(F.count(F.lit(1)).alias("_n"),
                                           *[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_bkt",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off_n"),
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sums])
    # left join: an inner join would make the optimizer add an inferred
    # not-null filter that evaluates the bucket search a second time
    out = local.join(F.broadcast(offsets), "_bkt", "left")
    extra = []
    if index_col:
        extra.append((F.col("_off_n") + F.col("_lpos")).alias(index_col))
    for c in sums:
        cum = F.col(f"_off_{c}") + F.col(f"_lcum_{c}")
        extra.append((cum if inclusive else cum - F.col(c)).alias(f"_cum_{c}"))
    return out.select(*df.columns, *extra)


def dense_index(df: DataFrame, order: list, name: str = "index", start: int = 1) -> DataFrame:
    """``row_number() over (order by ...)`` without a single-partition window."""
    out = ordered_scan(df, order, index_col="_index")
    return out.withColumn(name, F.col("_index") + F.lit(start - 1)).drop("_index")


def grouped_running_sum(df: DataFrame, group: list[str], order: list, value,
                        name, inclusive: bool = True) -> DataFrame:
    """Per-group running sum of ``value`` (one column or a list) in ``order``;
    a NULL in the group's columns is a value of its own.

    Rows go to range buckets of ``(group, order)``, so a hot group is spread
    over several. Each bucket sums within its groups; only a bucket's first
    group can continue from an earlier bucket, where it is then the last: its
    carry-in comes from a table of at most two rows a bucket, which is
    broadcast. The bucketed rows are written once and read twice."""
    values = [value] if isinstance(value, str) else list(value)
    names = [name] if isinstance(name, str) else list(name)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucketed = cut_lineage(with_range_bucket(df, [*group, *order], n))
    g = F.struct(*group)
    run = (Window.partitionBy("_bkt", *group).orderBy(*_keys(order))
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = bucketed.repartitionByRange(n, "_bkt").select("*", *[F.sum(v).over(run).alias(f"_run_{v}") for v in values])
    totals = bucketed.groupBy("_bkt", g.alias("_g")).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    ends = totals.groupBy("_bkt").agg(F.min("_g").alias("_lo"), F.max("_g").alias("_hi"))
    edge = totals.join(F.broadcast(ends), "_bkt").filter(F.col("_g").eqNullSafe(F.col("_lo")) | F.col("_g").eqNullSafe(F.col("_hi")))
    before = Window.partitionBy("_g").orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    carry = edge.select(F.col("_bkt").alias("_cb"), "_g", *[F.sum(f"_t_{v}").over(before).alias(f"_c_{v}") for v in values])
    res = local.join(F.broadcast(carry), (F.col("_bkt") == F.col("_cb")) & g.eqNullSafe(F.col("_g")), "left")
    zero = F.lit(0)
    outs = [(F.coalesce(F.col(f"_c_{v}"), zero) + F.coalesce(F.col(f"_run_{v}"), zero)
             - (zero if inclusive else F.coalesce(F.col(v), zero))).alias(o) for v, o in zip(values, names)]
    return res.select(*df.columns, *outs)
