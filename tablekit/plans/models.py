"""Model fitting with ``pyspark.ml``: GLMs, OLS, tree ensembles, MLP, ALS.

Fits are distributed by Spark ML; inputs reused across iterations are
cached for the duration of the fit and released after.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import IllegalArgumentException, PySparkException
from pyspark.ml.classification import (GBTClassifier, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_ws
from ..operators.ordering import dense_index, grouped_running_sum
from ..operators.sampling import PRIME, mixed_finish, seeded_hash
from ..session import checkpoint_dir, cut_lineage, sized_shuffles
from .grid import run_grid

# Least number of user and of item blocks of an ALS fit, rows that a
# block holds before there are more.
BLOCKS, BLOCK_ROWS = 6, 25_000_000
# Of a grid of ALS fits: rows of all fits that run at a time, and of a block of each.
GRID_ROWS, GRID_BLOCK_ROWS = 100_000_000, 13_000_000
DOC_FEATURES = ["n_chars", "n_words", "avg_word_len", "upper_share", "digit_share",
                "symbol_share", "n_lines"]


def doc_features(df: DataFrame, text: str = "text") -> DataFrame:
    """Numeric text features (all native expressions)."""
    t = F.col(text)
    n = F.greatest(F.length(t), F.lit(1)).cast("double")
    words = F.size(split_ws(t))

    def share(pattern):
        return (F.length(t) - F.length(F.regexp_replace(t, pattern, ""))) / n
    return df.withColumns({
        "n_chars": F.length(t).cast("double"), "n_words": words.cast("double"),
        "avg_word_len": F.length(F.regexp_replace(t, "\\s+", "")) / F.greatest(words, F.lit(1)),
        "upper_share": share("\\p{Lu}"), "digit_share": share("\\p{N}"),
        "symbol_share": share("[^\\s\\p{L}\\p{N}]"),
        "n_lines": (F.size(F.split(t, "\n"))).cast("double")})


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Vector column from numeric/boolean columns (labels and ids excluded by
    the caller)."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def glm_summary(df: DataFrame, label: str, cols: list[str], family: str = "binomial",
                link: str | None = None, max_iter: int = 25) -> tuple:
    """Fit a GLM and return (model, one-row summary DataFrame)."""
    # written: every iteration and each figure of the summary reads the rows again
    data = cut_lineage(assemble(df, cols).select("features", F.col(label).cast("double").alias("label")))
    glr = GeneralizedLinearRegression(family=family, maxIter=max_iter, regParam=0.0)
    if link:
        glr = glr.setLink(link)
    model = glr.fit(data)
    s = model.summary
    spark = df.sparkSession
    try:
        pvals, ok = [float(x) for x in s.pValues], True
    except (Py4JJavaError, IllegalArgumentException, PySparkException) as e:  # a singular design has no standard errors
        if "No p-value" not in str(e) and "No Std. Error" not in str(e):
            raise
        pvals, ok = [None] * (len(cols) + 1), False
    row = [(family, link or "canonical", float(s.aic), float(s.deviance), float(s.nullDeviance),
            int(s.residualDegreeOfFreedom), int(s.residualDegreeOfFreedomNull),
            [float(c) for c in model.coefficients], float(model.intercept), pvals, ok)]
    schema = ("family string, link string, aic double, deviance double, null_deviance double, "
              "df_resid bigint, df_null bigint, coefficients array<double>, intercept double, "
              "p_values array<double>, has_se boolean")
    return model, spark.createDataFrame(row, schema)


def score_equations(fitted: DataFrame, label: str, cols: list[str], digits: int = 4) -> DataFrame:
    """``(term, score, n)``: for each predictor and the intercept the sum of x (y - mu)
    over the rows, relative to the sum of |x|; 0 at the fit of a canonical link."""
    off = F.col(label).cast("double") - F.col("prediction")
    size = [F.greatest(F.sum(F.abs(F.col(c))), F.lit(1.0)) for c in cols]
    terms = [F.struct(F.lit(c).alias("term"), (F.sum(F.col(c) * off) / s).alias("score")) for c, s in zip(cols, size)]
    terms.append(F.struct(F.lit("(intercept)").alias("term"), F.avg(off).alias("score")))
    one = fitted.agg(F.array(*terms).alias("t"), F.count(F.lit(1)).alias("n"))
    return one.select(F.explode("t").alias("t"), "n").select("t.term", (F.round("t.score", digits) + 0.0).alias("score"), "n")


def factor_equations(train: DataFrame, users: DataFrame, items: DataFrame, alpha: float, reg: float,
                     user: str = "userId", item: str = "itemId", rating: str = "count", least: float = 1e-3) -> DataFrame:
    """``(user, solved)``: whether each user's factors x solve
    (Y'Y + sum a r y y' + reg n) x = sum (1 + a r) y over the user's n items, to ``least`` of
    the right side's size. Sums are aggregates by user and factor; Y'Y has rank squared entries."""
    items = items.select(F.col("id").alias(item), F.col("features").cast("array<double>").alias("_y"))
    users = users.select(F.col("id").alias(user), F.col("features").cast("array<double>").alias("_x"))
    products = F.flatten(F.transform("_y", lambda a, i: F.transform("_y", lambda b, j: F.struct(i.alias("i"), j.alias("j"), (a * b).alias("ab")))))
    gram = items.select(F.explode(products).alias("p")).groupBy("p.i", "p.j").agg(F.sum("p.ab").alias("s"))
    gram = gram.groupBy(F.col("i").alias("_k")).agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "s"))), lambda e: e["s"]).alias("_g"))
    c = F.lit(alpha) * F.col(rating)
    rows = train.join(items, item).join(users, user)
    dot = F.aggregate(F.zip_with("_x", "_y", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    rows = rows.select(user, c.alias("_c"), dot.alias("_d"), F.posexplode("_y").alias("_k", "_v"))
    sums = rows.groupBy(user, "_k").agg(F.sum((F.col("_c") * F.col("_d") - 1 - F.col("_c")) * F.col("_v")).alias("_left"),
                                        F.sum((1 + F.col("_c")) * F.col("_v")).alias("_right"), F.count(F.lit(1)).alias("_n"))
    own = F.aggregate(F.zip_with("_x", "_g", lambda x, g: x * g), F.lit(0.0), lambda a, x: a + x)
    off = F.col("_left") + own + reg * F.col("_n") * F.element_at("_x", F.col("_k") + 1)
    return (sums.join(users, user).join(gram, "_k").groupBy(user)
            .agg((F.sqrt(F.sum(off * off)) <= least * F.sqrt(F.sum(F.col("_right") * F.col("_right")))).alias("solved")))


def ols_multi(df: DataFrame, label: str, cols: list[str]) -> DataFrame:
    """Normal-equation least squares with the full summary as one row."""
    data = assemble(df, cols).select("features", F.col(label).alias("label"))
    model = LinearRegression(solver="normal", regParam=0.0).fit(data)
    s = model.summary
    try:
        se, t, p, ok = ([float(x) for x in s.coefficientStandardErrors], [float(x) for x in s.tValues],
                        [float(x) for x in s.pValues], True)
    except (Py4JJavaError, IllegalArgumentException, PySparkException) as e:  # a singular design has no standard errors
        if "No Std. Error" not in str(e) and "No p-value" not in str(e) and "No t-statistic" not in str(e):
            raise
        se = t = p = [None] * (len(cols) + 1)
        ok = False
    row = [([float(c) for c in model.coefficients], float(model.intercept), float(s.r2),
            float(s.explainedVariance), int(s.degreesOfFreedom), se, t, p, ok)]
    return df.sparkSession.createDataFrame(
        row, "coefficients array<double>, intercept double, r2 double, explained_variance double, "
             "df_resid bigint, std_errors array<double>, t_values array<double>, "
             "p_values array<double>, has_se boolean")


def classifier(kind: str, label: str = "label", seed: int = 0, **params):
    if kind == "gbt":
        return GBTClassifier(labelCol=label, seed=seed, **params)
    if kind == "rf":
        # a row's node in each tree is kept from pass to pass: deep trees aren't walked from the root in every one
        return RandomForestClassifier(labelCol=label, seed=seed, cacheNodeIds=True, **params)
    if kind == "mlp":
        return MultilayerPerceptronClassifier(labelCol=label, seed=seed, **params)
    raise ValueError(kind)


def fit_evaluate(train: DataFrame, test: DataFrame, kind: str, label: str = "label", **params):
    """Fit on ``train``, score ``test``; returns (model, predictions, AUC)."""
    train = train.cache()
    try:
        model = classifier(kind, label, **params).fit(train)
    finally:
        train.unpersist()
    pred = model.transform(test)
    return model, pred, area_under_curve(pred, label)


def area_under_curve(pred: DataFrame, label: str = "label") -> float:
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC").evaluate(pred)


def classifier_grid(train: DataFrame, test: DataFrame, kind: str, points: list[dict], names: dict[str, str],
                    table: str, label: str = "label") -> DataFrame:
    """AUC on ``test`` of a classifier fitted on ``train`` at every point; ``names``:
    the classifier's parameters and their column names. Both sets are written once."""
    train, test = cut_lineage(train), cut_lineage(test)

    def fit(point: dict) -> dict:
        params = {k: point[c] for k, c in names.items()}
        return {"auc": area_under_curve(classifier(kind, label, **params).fit(train).transform(test), label)}

    schema = ", ".join([f"{c} int" for c in names.values()] + ["auc double"])
    return run_grid(train.sparkSession, points, fit, schema, table)


def probability_of_one(pred: DataFrame, key: str) -> DataFrame:
    """P(class 1) as a double rounded to 6 digits, ordered by key."""
    return (pred.select(key, F.round(vector_to_array("probability")[1], 6).alias("predict"))
            .orderBy(key))


def als(rank: int = 10, alpha: float = 2.0, reg: float = 2.0, max_iter: int = 10,
        seed: int = 0, user: str = "userId", item: str = "itemId", rating: str = "count") -> ALS:
    """Implicit-feedback ALS (confidence ``1 + alpha * r``); unknown users or
    items score NaN."""
    return ALS(rank=rank, alpha=alpha, regParam=reg, maxIter=max_iter, seed=seed,
               implicitPrefs=True, userCol=user, itemCol=item, ratingCol=rating,
               coldStartStrategy="nan", checkpointInterval=5)


def als_blocks(rows: int, block_rows: int = BLOCK_ROWS) -> int:
    """User and item blocks of a fit: a factor is sent to every block of the other side
    that it has a row in, in each iteration, so traffic goes by their number. As few as hold
    ``block_rows`` rows each, and ``BLOCKS`` at least."""
    return max(BLOCKS, -(-rows // block_rows))


def als_side_by_side(rows: int, most: int = 4) -> tuple[int, int]:
    """How many fits of ``rows`` rows run at a time, up to ``most``, and the blocks of each.
    A task holds its block's rows and the factors sent to it on the heap, where Spark
    can't spill them, and fits side by side fill every core with such tasks. So the fits
    hold ``GRID_ROWS`` rows together, and a large one runs by itself."""
    return max(1, min(most, GRID_ROWS // max(rows, 1))), als_blocks(rows, GRID_BLOCK_ROWS)


def fit_als(train: DataFrame, blocks: int | None = None, **params):
    checkpoint_dir(train.sparkSession)  # ALS checkpoints factor lineage
    train = train.cache()
    try:
        return als(**params).setNumBlocks(blocks or als_blocks(train.count())).fit(train)
    finally:
        train.unpersist()


def score_pairs(model, pairs: DataFrame, user: str = "userId", item: str = "itemId") -> DataFrame:
    """Score given pairs: one row a pair, NaN for an unknown user or item. The
    rows are counted against the pairs, and a difference is an error; pairs that are
    costly to make should be a table."""
    want = pairs.count()
    with sized_shuffles(pairs.sparkSession, want):
        scored = cut_lineage(model.transform(pairs).select(user, item, "prediction"))
    got = scored.count()
    if want != got:
        raise ValueError(f"{got} scores for {want} pairs")
    return scored


def score_report(scored: DataFrame) -> DataFrame:
    """``(n_scored, n_nan)`` of scored pairs."""
    return scored.agg(F.count(F.lit(1)).alias("n_scored"), F.count(F.when(F.isnan("prediction"), 1)).alias("n_nan"))


def _integer_key(df: DataFrame, name: str):
    """The column as an integer for ``mixed_hash`` (other types by their hash)."""
    if df.schema[name].dataType.typeName() in ("byte", "short", "integer", "long"):
        return F.col(name).cast("long")
    return F.pmod(F.xxhash64(name), F.lit(PRIME))


def _with_mixed_hash(df: DataFrame, name: str, key, seed: int) -> DataFrame:
    """``mixed_hash`` as a column, its inner value a column first: nested, each level
    would be computed once more for every use of it."""
    inner = df.withColumn("_inner", seeded_hash(key, seed))
    return inner.withColumn(name, mixed_finish(F.col("_inner"), seed)).drop("_inner")


def negative_sampling(positives: DataFrame, candidates: DataFrame, seed: int = 0,
                      user: str = "userId", item: str = "itemId") -> DataFrame:
    """Per user, as many unseen items as positives, drawn uniformly (with
    replacement) from ``candidates``, unless as many draws as there are
    candidates don't give them.

    Draws are hashes of a positive row and the draw's number, so that a user with a
    third of all rows spreads over many tasks; a user's draws count by number, then by
    hash. The first draw of every row is made for all users at once; a user whose draws
    all hold has its items. Only users short of items draw on,
    two in each round (a user with a share f of the candidates needs about 1 / (2 f) rounds at
    most), and only their counts go from round to round. Their cut is a
    distributed grouped running count."""
    cand = cut_lineage(dense_index(candidates.select(item).distinct(), [item], name="_ci"))
    n_cand = cand.count()
    if not n_cand:
        return positives.select(user, item).limit(0)
    keys = _integer_key(positives, user), _integer_key(positives, item)
    pos = positives.select(user, item, keys[0].alias("_uk"), keys[1].alias("_ik"))
    seen = pos.select(user, item, F.lit(0).alias("_valid")).distinct()

    def drawn(rows, first, last):
        # the hash of a row and a draw's number, from 0 to PRIME squared
        d = _with_mixed_hash(rows.select(user, "_uk", "_ik"), "_uh", F.col("_uk"), seed)
        d = _with_mixed_hash(d, "_ih", F.col("_uh") + F.col("_ik"), seed + 1).select(user, "_ih")
        d = d.withColumn("_d", F.explode(F.sequence(F.lit(first), F.lit(last)))).withColumn("_n", F.col("_ih") + F.col("_d"))
        d = _with_mixed_hash(_with_mixed_hash(d, "_a", F.col("_n"), seed + 2), "_b", F.col("_n"), seed + 3)
        d = d.select(user, "_d", (F.col("_a") * PRIME + F.col("_b")).alias("_h"))
        d = d.withColumn("_ci", F.pmod(F.col("_h"), F.lit(n_cand)) + 1).join(cand, "_ci").drop("_ci")
        d = d.join(seen, [user, item], "left").withColumn("_valid", F.coalesce("_valid", F.lit(1)))
        return cut_lineage(d.withColumn("_one", F.lit(1)))

    def counts(draws):
        return draws.groupBy(user).agg(F.sum("_valid").alias("_kept"), F.sum("_one").alias("_made"))

    with sized_shuffles(positives.sparkSession, positives.count()):
        draws = drawn(pos, 1, 1)
        n_pos = pos.groupBy(user).agg(F.count(F.lit(1)).alias("_npos"))
        state = counts(draws).join(n_pos, user)
        # users for whom some draw fails, or who have more draws than there are candidates
        state = cut_lineage(state.filter((F.col("_kept") < F.col("_npos")) | (F.col("_made") > n_cand)))
        whole = draws.join(state.select(user), user, "left_anti").select(user, item)
        draws, short, last = draws.join(state.select(user), user, "left_semi"), state, 1
        while True:
            short = cut_lineage(short.filter((F.col("_kept") < F.col("_npos")) & (F.col("_made") < n_cand)))
            if short.isEmpty():
                break
            more = drawn(pos.join(short.select(user), user, "left_semi"), last + 1, last + 2)
            last += 2
            draws = draws.unionByName(more)
            both = short.unionByName(counts(more).withColumn("_npos", F.lit(None).cast("long")))
            short = both.groupBy(user).agg(F.sum("_kept").alias("_kept"), F.sum("_made").alias("_made"), F.max("_npos").alias("_npos"))
        ranked = grouped_running_sum(draws, [user], ["_d", "_h", item], ["_one", "_valid"], ["_attempt", "_kept"])
    out = (ranked.join(state.select(user, "_npos"), user)
           .filter((F.col("_valid") == 1) & (F.col("_kept") <= F.col("_npos"))
                   & (F.col("_attempt") <= n_cand)))
    return whole.unionByName(out.select(user, item))
