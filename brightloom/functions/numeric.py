"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rounded(c: Column | str, digits: int = 4) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``, null where the denominator is zero."""
    return F.when(den != 0, num / den)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def corrected_skew(c: Column | str) -> Column:
    """Bias-corrected sample skewness from population moments (null below 3 values)."""
    c = F.col(c) if isinstance(c, str) else c
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def corrected_kurtosis(c: Column | str) -> Column:
    """Bias-corrected excess kurtosis from population moments (null below 4 values)."""
    c = F.col(c) if isinstance(c, str) else c
    n = F.count(c).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))


def digamma(c: Column) -> Column:
    """Digamma of a whole number from 1: the series at ``c + 6`` less the steps up to it."""
    x = c.cast("double") + 6
    steps = sum((1 / (c.cast("double") + j) for j in range(1, 6)), 1 / c.cast("double"))
    return F.log(x) - 1 / (2 * x) - 1 / (12 * x * x) + 1 / (120 * x * x * x * x) - 1 / (252 * x * x * x * x * x * x) - steps
