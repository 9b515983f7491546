"""Statistical functions as column expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Lanczos coefficients (g = 7, nine terms): fixed values.
LANCZOS = [
    0.99999999999980993,
    676.5203681218851,
    -1259.1392167224028,
    771.32342877765313,
    -176.61502916214059,
    12.507343278686905,
    -0.13857109526572012,
    9.9843695780195716e-6,
    1.5056327351493116e-7,
]


def log_gamma(x: Column) -> Column:
    """ln of the gamma function for x >= 0.5."""
    z = x - 1
    total = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], 1):
        total = total + F.lit(c) / (z + i)
    t = z + 7.5
    return F.lit(0.9189385332046727) + (z + 0.5) * F.log(t) - t + F.log(total)


@F.pandas_udf(DoubleType())
def beta_fraction(a: pd.Series, b: pd.Series, x: pd.Series) -> pd.Series:
    """The continued fraction of the incomplete beta function, by the modified Lentz scheme, for a whole batch at once.

    The number of steps depends on the arguments, so built-in functions can only say it by a lambda, which is interpreted.
    """
    p, q, z = (np.asarray(v, float) for v in (a, b, x))
    with np.errstate(all="ignore"):
        c, d = np.ones(len(p)), 1 / (1 - (p + q) * z / (p + 1))
        h = d.copy()
        for m in range(1, 100_000):
            before = h
            for e in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
                c, d = 1 + e / c, 1 / (1 + e * d)
                h = h * c * d
            if not np.any(np.abs(h - before) > 1e-15 * np.abs(h)):
                break
    return pd.Series(h)


def with_t_test(df: DataFrame, m1: Column, s1: Column, n1: Column, m2: Column, s2: Column, n2: Column, out: str = "pval") -> DataFrame:
    """``df`` with the two-sided p-value of the t-test with pooled variance, from means, sample deviations and counts.

    Zero variance in both groups: 0 if the means differ, else null. Each step is a column of its own, so that
    no expression is copied into another many times.
    """
    c = F.col
    nu = (n1 + n2 - 2).cast("double")
    df = df.withColumns({"t_nu": nu, "t_gap": (m1 - m2) * (m1 - m2), "t_sum": (n1 - 1) * s1 * s1 + (n2 - 1) * s2 * s2, "t_inverse": 1.0 / n1 + 1.0 / n2})
    df = df.withColumn("t_spread", c("t_sum") / F.when(c("t_nu") > 0, c("t_nu")) * c("t_inverse"))
    df = df.withColumns({"t_a": c("t_nu") / 2, "t_x": c("t_nu") / (c("t_nu") + F.try_divide("t_gap", "t_spread"))})
    df = df.withColumn("t_flip", c("t_x") >= (c("t_a") + 1) / (c("t_a") + 2.5))
    df = df.withColumns({"t_fa": F.when(c("t_flip"), 0.5).otherwise(c("t_a")), "t_fb": F.when(c("t_flip"), c("t_a")).otherwise(0.5), "t_fx": F.when(c("t_flip"), 1 - c("t_x")).otherwise(c("t_x"))})
    df = df.withColumns({"t_half": c("t_a") + 0.5, "t_known": (c("t_nu") > 0) & (c("t_spread") > 0) & (c("t_gap") > 0)})
    front = F.exp(log_gamma(c("t_half")) - log_gamma(F.greatest(c("t_a"), F.lit(0.5))) - F.lit(0.5723649429247001) + c("t_a") * F.log("t_x") + 0.5 * F.log(1 - c("t_x")))
    df = df.withColumns({"t_front": front, "t_fraction": F.when(c("t_known"), beta_fraction(c("t_fa"), c("t_fb"), c("t_fx")))})
    df = df.withColumn("t_tail", c("t_front") * c("t_fraction") / c("t_fa"))
    p = F.when(c("t_nu") <= 0, None).when(c("t_spread") == 0, F.when(c("t_gap") > 0, 0.0)).when(c("t_gap") == 0, 1.0).when(c("t_flip"), 1 - c("t_tail")).otherwise(c("t_tail"))
    return df.withColumn(out, p).drop(*(n for n in df.columns if n.startswith("t_")))


def nonzero(x: Column, tiny: float = 1e-20) -> Column:
    """Zero as a tiny number, so that ratios exist."""
    return F.when(x == 0, tiny).otherwise(x)


def log2_ratio(base: Column, other: Column) -> Column:
    return F.log2(nonzero(other)) - F.log2(nonzero(base))


def minus_log10(p: Column) -> Column:
    return F.when(p <= 0, F.lit(float("inf"))).otherwise(0.0 - F.log10(p))  # 1 gives 0, not -0


def above(a: Column, b: Column, digits: int = 9) -> Column:
    """a > b, where numbers whose difference rounds to 0 are equal: the last digits of sums of doubles depend on their order."""
    return (a > b) & (F.round(a - b, digits) != 0)
