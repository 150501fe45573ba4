"""Recommender plans over an interaction table ``(userId, itemId, count)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import group_agg
from ..operators.ordering import grouped_running_sum, ordered_scan
from ..session import cut_lineage, sized_shuffles

UNKNOWN_NAME = "[unknown]"


def item_popularity(ui: DataFrame) -> DataFrame:
    """Per item: total plays and number of users."""
    return group_agg(ui, ["itemId"], {"count": "sum", "userId": "count"}, {"count": "plays", "userId": "users"})


def user_activity(ui: DataFrame) -> DataFrame:
    """Per user: total plays and number of items."""
    return group_agg(ui, ["userId"], {"count": "sum", "itemId": "count"}, {"count": "plays", "itemId": "items"})


def top_items(ui: DataFrame, names: DataFrame, n: int = 20) -> DataFrame:
    """Most popular named items. The inner join with names runs on the
    aggregate (one row per item, already partitioned by item), and the top-n
    is a bounded TakeOrderedAndProject."""
    pop = item_popularity(ui).join(names, "itemId")
    return pop.orderBy(F.col("users").desc(), F.col("itemId")).limit(n)


def top_users(ui: DataFrame, n: int = 10) -> DataFrame:
    return user_activity(ui).orderBy(F.col("plays").desc(), F.col("userId")).limit(n)


def clean_interactions(ui: DataFrame, names: DataFrame, min_items: int = 15,
                       max_items: int = 4000, min_users: int = 5,
                       iterate: bool = False) -> DataFrame:
    """Keep users with ``min_items < items < max_items`` and items with more
    than ``min_users`` users and a known name. Both filters are computed on
    the input (single pass); ``iterate=True`` repeats until nothing changes
    (k-core), a written table each round. The kept users and items are written
    before the semi joins, so that both join inputs are plain shuffles and a
    popular item's or a heavy user's partition can be split."""
    def one_pass(x: DataFrame) -> DataFrame:
        users = (x.groupBy("userId").agg(F.count("itemId").alias("_ni"))
                 .filter((F.col("_ni") > min_items) & (F.col("_ni") < max_items)).select("userId"))
        items = (x.groupBy("itemId").agg(F.count("userId").alias("_nu"))
                 .filter(F.col("_nu") > min_users)
                 .join(names.filter(F.col("name") != UNKNOWN_NAME), "itemId", "left_semi"))
        users, items = cut_lineage(users), cut_lineage(items.select("itemId"))
        return x.join(items, "itemId", "left_semi").join(users, "userId", "left_semi") \
                .select("userId", "itemId", "count")

    out = one_pass(ui)
    if not iterate:
        return out
    prev = ui.count()
    while True:
        out = cut_lineage(out)
        cur = out.count()
        if cur == prev:
            return out
        prev = cur
        out = one_pass(out)


def sparsity(ui: DataFrame, catalogue: DataFrame | None = None) -> DataFrame:
    """rows / (users x items); items are the catalogue size when given,
    otherwise the items seen."""
    base = ui.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.countDistinct("userId").alias("n_users"),
                  F.countDistinct("itemId").alias("n_items_seen"))
    if catalogue is not None:
        base = base.withColumn("n_items_catalogue", catalogue.agg(F.countDistinct("itemId")).scalar())
        denom = F.col("n_users") * F.col("n_items_catalogue")
    else:
        denom = F.col("n_users") * F.col("n_items_seen")
    return base.withColumn("sparsity", F.col("n_rows") / denom)


def hashed_score(user: str = "userId", item: str = "itemId") -> Column:
    """Deterministic stand-in score in [0, 1), repeatable in any SQL engine."""
    return (F.pmod(F.col(item).cast("long") * 7919 + F.col(user).cast("long") * 104729,
                   F.lit(1000)) / F.lit(1000.0))


def hashed_negatives(ui: DataFrame, n_items: Column, mult: int = 31, add: int = 17) -> DataFrame:
    """One candidate per positive ``(u, i)``: item ``(i*mult + u*add) % n + 1``,
    dropped when it is a positive of ``u``; de-duplicated."""
    cand = ui.select("userId", (F.pmod(F.col("itemId").cast("long") * mult
                                       + F.col("userId").cast("long") * add, n_items) + 1)
                     .cast("int").alias("itemId"))
    return cand.join(ui.select("userId", "itemId"), ["userId", "itemId"], "left_anti").distinct()


def mean_user_auc(scored: DataFrame, user: str = "userId", score: str = "score",
                  label: str = "is_pos", parity: bool = False, rows: int = 0) -> DataFrame:
    """Mean over users of the share of (positive, negative) pairs whose
    positive scores strictly higher (ties count as wrong).

    No pair expansion: per user and distinct score, count positives and
    negatives, then a per-user running sum of negatives in score order gives
    the negatives strictly below each positive. NaN scores are dropped and
    counted. ``parity=True`` reproduces dropping users with zero correct pairs.
    ``rows``: about how many there are, if known; shuffles get partitions by it.
    """
    clean = scored.filter(~F.isnan(F.col(score)) & F.col(score).isNotNull())
    # per (user, score) counts feed several passes of the scan below:
    # materialise them once instead of re-running the scoring lineage
    with sized_shuffles(scored.sparkSession, rows):
        per = cut_lineage(clean.groupBy(user, score)
                          .agg(F.sum(F.col(label).cast("long")).alias("_pos"),
                               F.sum((1 - F.col(label).cast("long"))).alias("_neg")))
        below = grouped_running_sum(per, [user], [score], "_neg", "_neg_below", inclusive=False)
    users = (below.groupBy(user)
             .agg(F.sum(F.col("_pos") * F.col("_neg_below")).alias("correct"),
                  F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg")))
    users = users.withColumn("auc", F.try_divide(F.col("correct").cast("double"),
                                                 (F.col("n_pos") * F.col("n_neg")).cast("double")))
    if parity:
        users = users.filter(F.col("correct") > 0)
    return users.agg(F.avg("auc").alias("mean_auc"),
                     F.count("auc").alias("n_users"))


def auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Exact area under the ROC curve (ties count one half), from per-score
    counts and a distributed running sum — no global rank window. NULL if
    only one class occurs."""
    per = (scored.groupBy(score)
           .agg(F.sum(F.col(label).cast("long")).alias("_pos"),
                F.sum((1 - F.col(label).cast("long"))).alias("_neg")))
    scanned = ordered_scan(per, [score], sums=["_neg"], index_col=None, inclusive=False)
    return scanned.agg(
        F.try_divide(F.sum(F.col("_pos") * (F.col("_cum__neg") + F.col("_neg") * 0.5)),
                     F.sum("_pos") * F.sum("_neg")).alias("auc"))
