"""Table access and defect injection shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def null_every(key: str, c: str, step: int = 10) -> Column:
    return F.when(F.col(key) % step != 0, F.col(c))


def spiked(key: str = "o_orderkey", c: str = "o_totalprice") -> Column:
    return F.when(F.col(key) % 997 == 0, F.col(c) * 10).otherwise(F.col(c))


def typo(key: str, c: str) -> Column:
    s = F.col(c)
    return F.when(
        F.col(key) % 37 == 0, F.concat(F.substring(s, 1, 2), F.lit("x"), s.substr(F.lit(4), F.length(s)))
    ).otherwise(s)


def doubled(df: DataFrame, key: str, step: int = 20) -> DataFrame:
    """Table plus a second copy of every ``step``-th row."""
    return df.unionAll(df.filter(F.col(key) % step == 0))
