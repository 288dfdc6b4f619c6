"""Welch's unequal-variance two-sample t-test.

The moments (n, mean, sample variance) of both samples come from one
aggregation over one scan; t and the Welch-Satterthwaite degrees of freedom
are column expressions on that one-row result.  Only the two-sided p-value
needs a special function (the regularised incomplete beta), evaluated by a
pandas UDF on the moments table -- one row per compared pair, never on the
data rows.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _gamma_ratio(a: float) -> float:
    """Gamma(a + 1/2) / Gamma(a) without cancellation for large ``a``."""
    if a < 100:
        return math.exp(math.lgamma(a + 0.5) - math.lgamma(a))
    r = 1.0 / a         # asymptotic series; the next term is below 1e-13
    return math.sqrt(a) * (1 - r / 8 + r ** 2 / 128 + 5 * r ** 3 / 1024
                           - 21 * r ** 4 / 32768 - 399 * r ** 5 / 262144)


def _rising_series(x: float, top: float, bottom: float) -> float:
    """Sum over n of x**n times the product of (top + k) / (bottom + k).

    All terms are positive, and beyond some n they shrink by a ratio that
    tends to x < 1, so the sum ends when a term no longer counts.
    """
    total = term = 1.0
    n = 0
    while True:
        ratio = x * (top + n) / (bottom + n)
        term *= ratio
        total += term
        n += 1
        if ratio < 1.0 and term * ratio < 1e-17 * total * (1.0 - ratio):
            return total


def t_two_sided_p(t: float, df: float) -> float:
    """Two-sided p-value of Student's t with ``df`` degrees of freedom.

    p = I_x(df/2, 1/2) with x = df / (df + t^2), by the hypergeometric series
    of the incomplete beta function on the side where its argument is at most
    one half.
    """
    if t is None or df is None or math.isnan(t) or math.isnan(df) or df <= 0:
        return float("nan")
    if t == 0:
        return 1.0
    a, q = df / 2.0, (t / math.sqrt(df)) ** 2
    log_x = -math.log1p(q)                       # log of x
    if math.isinf(q) or a * log_x < -700.0:
        return 0.0
    x, y = 1.0 / (1.0 + q), q / (1.0 + q)        # y = 1 - x
    front = math.exp(a * log_x) * math.sqrt(y) * _gamma_ratio(a) / math.sqrt(math.pi)
    if y <= 0.5:
        return max(0.0, 1.0 - 2.0 * front * _rising_series(y, a + 0.5, 1.5))
    return min(1.0, front / a * _rising_series(x, a + 0.5, a + 1.0))


def _ship_by_value() -> None:
    """Pickle this module's functions by value, so Python workers can run
    the UDF even where the package is not importable (no --py-files)."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # older cloudpickle: fall back to import by name
        pass


_ship_by_value()


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided_p(a, b) if pd.notna(a) and pd.notna(b)
                      else None for a, b in zip(t, df)], dtype="float64")


def welch_moments(df: DataFrame, value: str, a: Column, b: Column
                  ) -> DataFrame:
    """n, mean and sample variance of ``value`` where ``a`` / ``b`` hold,
    NaN treated as null, in one aggregation."""
    v = F.col(value)
    v = F.when(F.isnan(v), F.lit(None)).otherwise(v)
    va, vb = F.when(a, v), F.when(b, v)
    return df.agg(F.count(va).alias("n_a"), F.avg(va).alias("mean_a"),
                  F.var_samp(va).alias("var_a"), F.count(vb).alias("n_b"),
                  F.avg(vb).alias("mean_b"), F.var_samp(vb).alias("var_b"))


def welch_from_moments(m: DataFrame) -> DataFrame:
    """Adds t and df; null when a side has fewer than two values or both
    variances are zero."""
    # try_divide: a zero divisor gives null instead of an ANSI error, even
    # where Spark evaluates a guarded branch eagerly.
    div = F.try_divide
    sa = div(F.col("var_a"), F.col("n_a"))
    sb = div(F.col("var_b"), F.col("n_b"))
    se2 = sa + sb
    ok = (F.col("n_a") >= 2) & (F.col("n_b") >= 2) & (se2 > 0)
    t = F.when(ok, div(F.col("mean_a") - F.col("mean_b"), F.sqrt(se2)))
    dof = F.when(ok, div(se2 * se2,
                         div(sa * sa, F.col("n_a") - 1)
                         + div(sb * sb, F.col("n_b") - 1)))
    return m.withColumns({"t": t, "df": dof})


def welch_ttest(df: DataFrame, value: str, a: Column, b: Column,
                with_p: bool = True) -> DataFrame:
    """One row: n_a, mean_a, var_a, n_b, mean_b, var_b, t, df[, p]."""
    out = welch_from_moments(welch_moments(df, value, a, b))
    return out.withColumn("p", t_pvalue("t", "df")) if with_p else out
