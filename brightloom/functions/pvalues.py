"""Tail probabilities as column expressions.

They call static methods of the public Commons Math library shipped with Spark, so a p-value stays in
the plan of the (one-row) statistic it belongs to.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BETA = "org.apache.commons.math3.special.Beta"
_GAMMA = "org.apache.commons.math3.special.Gamma"
_ERF = "org.apache.commons.math3.special.Erf"


def _call(cls: str, method: str, *args: Column) -> Column:
    return F.java_method(F.lit(cls), F.lit(method), *[a.cast("double") for a in args]).cast("double")


def t_two_sided(t: Column, df: Column) -> Column:
    return F.when(
        t.isNotNull() & df.isNotNull(),
        _call(_BETA, "regularizedBeta", df / (df + t * t), df / 2, F.lit(0.5)),
    )


def f_upper(f: Column, d1: Column, d2: Column) -> Column:
    return F.when(f.isNotNull(), _call(_BETA, "regularizedBeta", d2 / (d2 + d1 * f), d2 / 2, d1 / 2))


def chi2_upper(x: Column, df: Column) -> Column:
    return F.when(x.isNotNull() & (df > 0), _call(_GAMMA, "regularizedGammaQ", df / 2, x / 2))


def normal_two_sided(z: Column) -> Column:
    return F.when(z.isNotNull(), _call(_ERF, "erfc", F.abs(z) / F.sqrt(F.lit(2.0))))
