"""Special functions as column expressions (evaluated JVM-side).

Used on one-row statistical summaries; no SciPy needed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanczos approximation coefficients (g = 7, n = 9).
LANCZOS_G = 7.0
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028,
           771.32342877765313, -176.61502916214059, 12.507343278686905,
           -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)

_TINY = 1e-300


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(float(x))


def lgamma(x) -> Column:
    """log Gamma(x) for x > 0 (Lanczos, ~15 significant digits)."""
    z = _c(x) - 1.0
    a = F.lit(LANCZOS[0])
    for i, coef in enumerate(LANCZOS[1:], start=1):
        a = a + F.lit(coef) / (z + float(i))
    t = z + LANCZOS_G + 0.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.ln(t) - t + F.ln(a)


def _cf(a: Column, b: Column, x: Column, iters: int) -> Column:
    """Continued fraction for the incomplete beta (modified Lentz)."""
    qab, qap, qam = a + b, a + 1.0, a - 1.0

    def fix(v):
        return F.when(F.abs(v) < _TINY, F.lit(_TINY)).otherwise(v)

    d0 = F.lit(1.0) / fix(F.lit(1.0) - qab * x / qap)
    init = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))

    def step(s, m):
        m = m.cast("double")
        m2 = m * 2.0
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d1 = F.lit(1.0) / fix(F.lit(1.0) + aa * s["d"])
        c1 = fix(F.lit(1.0) + aa / s["c"])
        h1 = s["h"] * d1 * c1
        aa2 = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d2 = F.lit(1.0) / fix(F.lit(1.0) + aa2 * d1)
        c2 = fix(F.lit(1.0) + aa2 / c1)
        return F.struct(c2.alias("c"), d2.alias("d"), (h1 * d2 * c2).alias("h"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(iters)), init, step, lambda s: s["h"])


def betainc(a, b, x, iters: int = 300) -> Column:
    """Regularised incomplete beta I_x(a, b)."""
    a, b, x = _c(a), _c(b), _c(x)
    front = F.exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * F.ln(x) + b * F.ln(F.lit(1.0) - x))
    direct = front * _cf(a, b, x, iters) / a
    flipped = F.lit(1.0) - front * _cf(b, a, F.lit(1.0) - x, iters) / b
    return (F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0))
            .when(x < (a + 1.0) / (a + b + 2.0), direct).otherwise(flipped))


def f_sf(f, d1, d2) -> Column:
    """Upper tail P(F > f) of the F(d1, d2) distribution."""
    f, d1, d2 = _c(f), _c(d1), _c(d2)
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def t_sf2(t, dof) -> Column:
    """Two-sided p-value of a t statistic."""
    t, dof = _c(t), _c(dof)
    return betainc(dof / 2.0, F.lit(0.5), dof / (dof + t * t))


def sig(x, digits: int = 10) -> Column:
    """Round to ``digits`` significant digits (decimal text round trip, so
    any engine with printf-style formatting gives the same double)."""
    return F.format_string(f"%.{digits - 1}e", _c(x)).cast("double")
