"""Statistical summaries: one-way ANOVA, simple OLS, scaling, classifier
metrics. Each is a fixed number of aggregation passes; results are one row
or one row per group, never a collected column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.special import f_sf, sig, t_sf2


def anova_oneway(df: DataFrame, y: str, c: str, with_p: bool = True) -> DataFrame:
    """Between/within sums of squares, mean squares, F and the upper-tail
    p-value, over the rows with a class and a value (NaN of the F ratio's parts
    is NULL: one class, or no row to spare). The within sum is each class's
    population variance times its size, a partial aggregate, so a class of any
    size needs no join."""
    df = df.select(c, y).filter(F.col(c).isNotNull() & F.col(y).isNotNull())
    groups = df.groupBy(c).agg(F.count(F.lit(1)).alias("_n"), F.avg(y).alias("_m"), F.var_pop(y).alias("_v"))
    grand = df.agg(F.avg(y)).scalar()
    between = groups.agg(F.count(F.lit(1)).alias("k"), F.sum("_n").alias("n"),
                         F.sum(F.col("_n") * F.pow(F.col("_m") - grand, 2)).alias("ss_between"),
                         F.sum(F.col("_n") * F.col("_v")).alias("ss_within"))
    out = between.select(
        "k", "n", (F.col("k") - 1).alias("df_between"), (F.col("n") - F.col("k")).alias("df_within"),
        "ss_between", "ss_within",
        F.try_divide("ss_between", F.col("k") - 1).alias("ms_between"),
        F.try_divide("ss_within", F.col("n") - F.col("k")).alias("ms_within"))
    out = out.withColumn("f", F.try_divide("ms_between", "ms_within"))
    if with_p:
        one = F.lit(1.0)  # no degree of freedom: no ratio, so no p-value either
        p = f_sf(F.col("f"), F.greatest(F.col("df_between").cast("double"), one), F.greatest(F.col("df_within").cast("double"), one))
        out = out.withColumn("p_value", F.when(F.col("f").isNotNull(), p))
    return out


def ols_simple(df: DataFrame, y: str, x: str, with_p: bool = True) -> DataFrame:
    """One-predictor least squares from one aggregation pass: slope,
    intercept, R^2, residual df, slope standard error, t and p."""
    s = df.agg(F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"),
               F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
               F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"))
    s = s.withColumn("df_resid", F.col("n") - 2)
    sse = F.col("syy") - F.col("slope") * F.col("slope") * F.col("sxx")
    s = s.withColumn("se_slope", F.sqrt(F.try_divide(F.try_divide(sse, F.col("df_resid")), F.col("sxx"))))
    s = s.withColumn("t_slope", F.try_divide("slope", "se_slope"))
    if with_p:
        p = t_sf2(F.col("t_slope"), F.greatest(F.col("df_resid").cast("double"), F.lit(1.0)))
        s = s.withColumn("p_slope", F.when(F.col("t_slope").isNotNull(), p))
    return s.drop("sxx", "syy")


def cross_products(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(i, j, s)``: sums of the products of all pairs of columns (``i <= j``), centred
    on their means, from one aggregate with a partial step."""
    mean = df.agg(F.struct(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)])).scalar()
    v = df.select(F.array(*[F.col(c) - mean[f"m{i}"] for i, c in enumerate(cols)]).alias("_v"))
    pairs = F.flatten(F.transform("_v", lambda x, i: F.transform(
        F.slice("_v", i + 1, len(cols)), lambda y, j: F.struct(i.alias("i"), (i + j).alias("j"), (x * y).alias("xy")))))
    return v.select(F.explode(pairs).alias("p")).groupBy("p.i", "p.j").agg(F.sum("p.xy").alias("s"))


def swept(matrix: Column, n: int, least: float = 1e-10) -> Column:
    """A symmetric matrix (array of rows) swept on its first ``n`` pivots: the inverse
    of that block stands there, the solution in the columns beyond it, and the remainder
    in the last corner. NULL if a pivot falls below ``least`` of what it was."""
    def sweep(state, k):
        m, first = state["m"], state["first"]
        pivot = m[k][k]

        def entry(row, i):
            def one(v, j):
                return (F.when((i == k) & (j == k), 1 / pivot).when(i == k, v / pivot).when(j == k, -v / pivot)
                        .otherwise(v - row[k] * m[k][j] / pivot))
            return F.transform(row, one)
        fine = m.isNotNull() & (pivot > least * first[k])
        return F.struct(F.when(fine, F.transform(m, entry)).alias("m"), first.alias("first"))

    first = F.transform(matrix, lambda row, i: row[i])
    start = F.struct(matrix.alias("m"), first.alias("first"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), start, sweep, lambda s: s["m"])


def ols_wide(df: DataFrame, y: str, xs: list[str], with_p: bool = True) -> DataFrame:
    """Least squares on any number of predictors, a row for each term and one for the
    intercept: ``(term, coefficient, std_error, t_value, p_value, r2, df_resid)``. Rows
    with a NULL are left out; a singular design gives NULLs. Cross products are one
    aggregate, the solve is a column expression on its one row."""
    cols, p = [*xs, y], len(xs)
    df = df.select(*cols).dropna().select(*[F.col(c).cast("double").alias(c) for c in cols])
    s = df.agg(F.struct(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)])).scalar()
    sums = cross_products(df, cols).agg(F.map_from_entries(F.collect_list(F.struct(F.col("i") * len(cols) + F.col("j"), "s"))).alias("_s"))
    here = F.sequence(F.lit(0), F.lit(p))
    matrix = F.transform(here, lambda i: F.transform(here, lambda j: F.try_element_at("_s", F.least(i, j) * len(cols) + F.greatest(i, j))))
    one = sums.select(s.alias("_m"), matrix.alias("_a")).withColumn("_w", swept(F.col("_a"), p))
    dof = F.col("_m.n") - p - 1
    one = one.withColumn("_rss", F.col("_w")[p][p]).withColumn("_var", F.try_divide(F.col("_rss"), dof))
    means = F.array(*[F.col(f"_m.m{i}") for i in range(p)])
    one = one.select("*", F.transform(F.sequence(F.lit(0), F.lit(p - 1)), lambda i: F.col("_w")[i][p]).alias("_b"), means.alias("_means"))
    at_means = F.aggregate(F.arrays_zip("_b", "_means"), F.lit(0.0), lambda a, x: a + x["_b"] * x["_means"])
    spread = F.aggregate(F.sequence(F.lit(0), F.lit(p - 1)), F.lit(0.0), lambda a, i: a + F.aggregate(
        F.sequence(F.lit(0), F.lit(p - 1)), F.lit(0.0), lambda b, j: b + F.col("_means")[i] * F.col("_w")[i][j] * F.col("_means")[j]))
    terms = [F.struct(F.lit(c).alias("term"), F.col("_b")[i].alias("coefficient"), F.sqrt(F.col("_var") * F.col("_w")[i][i]).alias("std_error"))
             for i, c in enumerate(xs)]
    terms.append(F.struct(F.lit("(intercept)").alias("term"), (F.col(f"_m.m{p}") - at_means).alias("coefficient"),
                          F.sqrt(F.col("_var") * (1 / F.col("_m.n") + spread)).alias("std_error")))
    out = one.select(F.explode(F.array(*terms)).alias("_t"), (1 - F.try_divide("_rss", F.col("_a")[p][p])).alias("r2"), dof.alias("df_resid"))
    out = out.select("_t.*", "r2", "df_resid").withColumn("t_value", F.try_divide("coefficient", "std_error"))
    if with_p:
        p_value = t_sf2(F.col("t_value"), F.greatest(F.col("df_resid").cast("double"), F.lit(1.0)))
        out = out.withColumn("p_value", F.when(F.col("t_value").isNotNull(), p_value))
    return out


def ols_residuals(df: DataFrame, y: str, x: str, digits: int = 12) -> DataFrame:
    """``y - (a + b x)`` with the fitted coefficients as scalars (rounded to
    ``digits`` significant digits so any engine reproduces the residuals)."""
    coef = df.agg(F.struct(sig(F.regr_intercept(y, x), digits).alias("a"),
                           sig(F.regr_slope(y, x), digits).alias("b"))).scalar()
    return df.withColumn("residual", F.col(y) - (coef["a"] + coef["b"] * F.col(x)))


def standard_scale(df: DataFrame, cols: list[str], digits: int = 12) -> DataFrame:
    """``(x - mean) / std`` with the *population* std, per column; means and
    stds come from one aggregation, applied as scalars. A constant column gives
    NULLs."""
    # all means and stds in one aggregation, one struct-valued scalar
    st = df.agg(F.struct(*[sig(F.avg(c), digits).alias(f"{c}__m") for c in cols],
                         *[sig(F.stddev_pop(c), digits).alias(f"{c}__s") for c in cols])).scalar()
    return df.withColumns({c: F.try_divide(F.col(c) - st[f"{c}__m"], st[f"{c}__s"]) for c in cols})


def minmax_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    st = df.agg(F.struct(*[F.min(c).alias(f"{c}__lo") for c in cols],
                         *[F.max(c).alias(f"{c}__hi") for c in cols])).scalar()
    return df.withColumns({c: F.try_divide(F.col(c) - st[f"{c}__lo"], st[f"{c}__hi"] - st[f"{c}__lo"])
                           for c in cols})


def log_loss(df: DataFrame, label: str, prob: str, eps: float = 1e-15) -> DataFrame:
    p = F.least(F.greatest(F.col(prob), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    return df.agg(F.avg(-(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("log_loss"),
                  F.count(F.lit(1)).alias("n"))
