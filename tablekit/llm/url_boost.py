"""URL filters: gradient-boosted trees on lexical features of labelled URLs.

A URL's features are its lengths, depth, shares of digits and signs, the entropy
of its characters, its parameters, and statistics of its suffixes and segments
(the host's last label and last two, the path's first segment and ending): how
many labelled URLs have the same one and which share of them is blocked. The
trees are Spark's own, fitted on at most ``PER_LABEL`` distinct labelled URLs of
each label, those with the least hashes of their groups; shares that a URL's own fold was
counted in never describe it while fitting. Everything is DataFrame expressions
and joins; only the statistics (at most a few rows for each URL of the sample) are broadcast.

Labels come from rules of a host and a path: a rule fits its host and all
subdomains if the path starts with the rule's; of those that fit the longest
wins. A URL with a rule has the rule's verdict, any other the trees'.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z
lower-cased; the path follows up to ``?``, ``#`` or the end. A null URL, or one without
``://``, has both empty, and the features of an empty text where they are counted from host or path. Equal URLs have
equal verdicts; repeated rows repeat them. Without labelled URLs of both kinds every URL
without a rule gets the one known verdict, ``allow`` if there is none. An empty table gives
an empty one; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import keep_columns, written

#: The sample's bound: distinct URLs a label, from so many hash groups.
PER_LABEL = 4992
GROUPS = 64
FOLDS = 5
#: Weight of the overall share in a suffix's share.
PRIOR = 5.0

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


# ---- parts of a URL ------------------------------------------------------

def url_parts(url: Column) -> tuple[Column, Column]:
    """``(host, path)``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest of the ``(verdict, host, path)`` rules that fits, as a struct
    ``(rule, verdict)``, or null. The rules are a literal in the plan."""
    own = F.array(*[F.struct(F.lit(len(h) + len(p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(h).alias("host"),
                             F.lit(p).alias("path"), F.lit(v).alias("verdict")) for v, h, p in rules])
    fits = F.filter(own, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]))
    return F.array_max(fits)


def _times(col: Column, pattern: str) -> Column:
    return F.regexp_count(col, F.lit(pattern)).cast("double")


def entropy(text: Column) -> Column:
    """Bits a character, from runs of the sorted characters."""
    chars = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))

    def bits(n: Column) -> Column:
        return F.when(n > 0, n * F.log2(n)).otherwise(0.0)

    def add(state: Column, c: Column) -> Column:
        same = state["last"] == c
        return F.struct(c.alias("last"), F.when(same, state["run"] + 1).otherwise(F.lit(1.0)).alias("run"),
                        F.when(same, state["done"]).otherwise(state["done"] + bits(state["run"])).alias("done"))

    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("done"))
    runs = F.aggregate(chars, start, add, lambda s: s["done"] + bits(s["run"]))
    size = F.greatest(F.length(text).cast("double"), F.lit(1.0))
    return F.log2(size) - runs / size


#: Kinds of suffixes and segments whose statistics are features.
SUFFIXES = ("label", "domain", "segment", "ending")
LEXICAL = ("url_length", "host_length", "path_length", "labels", "depth", "digits", "signs", "hyphens", "entropy",
           "host_entropy", "parameters", "query_length", "last_length", "encoded")
FEATURES = (*LEXICAL, *[f"{s}_{x}" for s in SUFFIXES for x in ("n", "share")])


def lexical(df: DataFrame, url: str = "url", host: str = "host", path: str = "path") -> DataFrame:
    """``df`` with the columns ``LEXICAL`` and ``SUFFIXES``."""
    u = F.coalesce(F.col(url), F.lit(""))
    h, p = F.col(host), F.col(path)
    size = F.greatest(F.length(u), F.lit(1)).cast("double")
    query = F.regexp_extract(u, "[?]([^#]*)", 1)
    last = F.regexp_extract(p, "([^/]*)/?$", 1)
    return df.select(
        "*", F.length(u).cast("double").alias("url_length"), F.length(h).cast("double").alias("host_length"),
        F.length(p).cast("double").alias("path_length"), (_times(h, "[^.]+")).alias("labels"), _times(p, "[^/]+").alias("depth"),
        (_times(u, "[0-9]") / size).alias("digits"), (_times(u, "[^A-Za-z0-9]") / size).alias("signs"), _times(u, "-").alias("hyphens"),
        entropy(u).alias("entropy"), entropy(h).alias("host_entropy"), _times(query, "[^&]+").alias("parameters"),
        F.length(query).cast("double").alias("query_length"), F.length(last).cast("double").alias("last_length"), _times(u, "%[0-9A-Fa-f]{2}").alias("encoded"),
        F.regexp_extract(h, "[^.]*$", 0).alias("label"), F.regexp_extract(h, "(?:[^.]*[.])?[^.]*$", 0).alias("domain"),
        F.regexp_extract(p, "^/([^/]*)", 1).alias("segment"), F.regexp_extract(last, "[.]([^.]*)$", 1).alias("ending"))


# ---- fitting -------------------------------------------------------------

@dataclass
class Model:
    trees: GBTClassificationModel | None
    stats: DataFrame | None
    share: float
    only: str | None = None


def sample(labelled: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """At most ``per_label`` distinct URLs of each label: of each hash group those
    with the least hashes, which tasks cut to size before any shuffle."""
    h = F.xxhash64("url")
    first = Window.partitionBy("blocked", "group").orderBy("hash", "url")
    rows = labelled.distinct().select("*", h.alias("hash"), F.pmod(h, F.lit(GROUPS)).alias("group"))
    return rows.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= per_label // GROUPS).select(
        "url", "host", "path", "blocked", F.pmod(F.xxhash64("hash"), F.lit(FOLDS)).alias("fold"))


def _named(df: DataFrame) -> Column:
    """Each row's suffixes, one array entry a kind."""
    return F.explode(F.array(*[F.struct(F.lit(s).alias("kind"), F.col(s).alias("value")) for s in SUFFIXES]))


def suffix_counts(rows: DataFrame, *keys: str) -> DataFrame:
    """``(kind, value, *keys, n, bad)`` of labelled rows."""
    return rows.select(*keys, "blocked", _named(rows).alias("x")).groupBy("x.kind", "x.value", *keys).agg(
        F.count("*").alias("n"), F.sum("blocked").alias("bad"))


def _with_statistics(rows: DataFrame, stats: DataFrame, share: float, *keys: str) -> DataFrame:
    """``rows`` with ``n`` and ``share`` of each suffix from ``(kind, value, *keys, n, bad)``."""
    for s in SUFFIXES:
        own = stats.filter(F.col("kind") == s).select(
            F.col("value").alias(s), *keys, F.log1p("n").alias(f"{s}_n"), ((F.col("bad") + PRIOR * share) / (F.col("n") + PRIOR)).alias(f"{s}_share"))
        rows = rows.join(F.broadcast(own), [s, *keys], "left")
    return rows.fillna(0.0, [f"{s}_n" for s in SUFFIXES]).fillna(share, [f"{s}_share" for s in SUFFIXES])


def learn(labelled: DataFrame, per_label: int = PER_LABEL, rounds: int = 30, depth: int = 4, seed: int = 5) -> Model:
    """Trees from ``(url, host, path, blocked)``, ``blocked`` 0 or 1."""
    rows = written(lexical(sample(labelled, per_label)), "url-sample")
    known = {r["blocked"]: r["count"] for r in rows.groupBy("blocked").count().collect()}
    if len(known) < 2:
        return Model(None, None, 0.0, "block" if 1 in known else "allow")
    share = known[1] / sum(known.values())
    stats = written(suffix_counts(rows), "url-suffixes")
    folds = suffix_counts(rows, "fold")
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(FOLDS - 1).cast("bigint"))).alias("fold")
    whole = stats.select("kind", "value", "n", "bad", other).join(
        folds.withColumnsRenamed({"n": "n_own", "bad": "bad_own"}), ["kind", "value", "fold"], "left")
    apart = written(whole.select("kind", "value", "fold", (F.col("n") - F.coalesce("n_own", F.lit(0))).alias("n"),
                                 (F.col("bad") - F.coalesce("bad_own", F.lit(0))).alias("bad")), "url-suffixes-apart")
    points = _assembled(_with_statistics(rows, apart, share, "fold")).select("features", F.col("blocked").cast("double").alias("label"))
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.2, seed=seed).fit(written(points, "url-points"))
    return Model(trees, stats, share)


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def score(df: DataFrame, model: Model) -> DataFrame:
    """``df`` (with ``url, host, path``) and ``score``, the trees' probability of a block."""
    if model.only:
        return df.withColumn("score", F.lit(float(model.only == "block")))
    rows = _assembled(_with_statistics(lexical(df), model.stats, model.share))
    return model.trees.transform(rows).select(*df.columns, vector_to_array("probability")[1].alias("score"))


def judge(df: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", url: str = "url", per_label: int = PER_LABEL) -> DataFrame:
    """``(key, host, path, rule, verdict, score)`` of every row; the trees learn
    from the URLs that a rule decides."""
    rows = keep_columns(df, [key, url]).toDF("key", "url")
    host, path = url_parts(F.col("url"))
    rows = rows.select("key", "url", host.alias("host"), path.alias("path")).withColumn("by_rule", rule_for(F.col("host"), F.col("path"), rules))
    labelled = rows.filter("by_rule is not null").select("url", "host", "path", (F.col("by_rule.verdict") == "block").cast("int").alias("blocked"))
    scored = score(rows, learn(labelled, per_label))
    own = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    return scored.select(F.col("key").alias(key), "host", "path", F.col("by_rule.rule").alias("rule"),
                         F.coalesce("by_rule.verdict", own).alias("verdict"), "score")
