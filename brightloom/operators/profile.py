"""Whole-column statistics as long tables. Each is one aggregation pass, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.functions.numeric import corrected_kurtosis, corrected_skew, numeric_columns, string_columns
from brightloom.operators.ranking import exact_quantiles, join_null_safe

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def per_column(df: DataFrame, columns: Sequence[str], stats: dict) -> DataFrame:
    """One row per column from one global aggregation: ``(column, <stat>...)``; ``stats`` maps name -> fn(col)."""
    one = df.agg(
        *[F.struct(F.lit(c).alias("column"), *[fn(c).alias(s) for s, fn in stats.items()]).alias(c) for c in columns]
    )
    return one.select(F.inline(F.array(*columns)))


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """``(value, n, share)``, nulls left out, most frequent first."""
    counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
    total = df.agg(F.count(c)).scalar()
    return counts.withColumn("share", F.col("n") / total).orderBy(F.desc("n"), c)


def count_distinct(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """``(column, n_unique)``, nulls left out.

    Exact counts meet under a 64-bit fingerprint per column, summed up in the tasks first, so that no value is a shuffle key; a
    second fingerprint tells values apart that share the first one.
    """
    if approximate:
        return per_column(df, columns, {"n_unique": lambda c: F.approx_count_distinct(F.col(c))})
    cells = [
        F.when(F.col(c).isNotNull(), F.struct(F.lit(i).alias("i"), F.xxhash64(c).alias("h"), F.xxhash64(F.lit(1), F.col(c)).alias("g"))) for i, c in enumerate(columns)
    ]
    each = df.select(F.explode(F.array_compact(F.array(*cells))).alias("e")).select("e.*")
    per = each.groupBy("i", "h").agg(F.min("g").alias("lo"), F.max("g").alias("hi"))
    counts = per.groupBy("i").agg((F.count("*") + F.count_if(F.col("lo") != F.col("hi"))).alias("n"))
    found = counts.agg(F.map_from_entries(F.collect_list(F.struct("i", "n"))).alias("m"))  # one entry per column
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.element_at("m", F.lit(i)), F.lit(0)).cast("long").alias("n_unique")) for i, c in enumerate(columns)])
    return found.select(F.inline(rows))


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return per_column(df, columns or df.columns, {"n_missing": lambda c: F.count_if(F.col(c).isNull())})


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return per_column(df, columns, {"skew": corrected_skew, "kurtosis": corrected_kurtosis})


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles, max per column."""
    columns = list(columns or numeric_columns(df))

    def d(c: str) -> Column:
        return F.col(c).cast("double")

    base = per_column(
        df, columns,
        {
            "n": lambda c: F.count(c), "mean": lambda c: F.avg(c), "std": lambda c: F.stddev_samp(c),
            "lowest": lambda c: F.min(d(c)), "highest": lambda c: F.max(d(c)),
        },
    )
    q = exact_quantiles(df, columns, QUARTILES).drop("n")
    return base.join(q, "column", "left").select("column", "n", "mean", "std", "lowest", "q1", "median", "q3", "highest")


def spread_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population variance and std, range, interquartile range."""
    base = per_column(
        df, columns,
        {
            "variance": lambda c: F.var_pop(c), "std": lambda c: F.stddev_pop(c),
            "range": lambda c: (F.max(c) - F.min(c)).cast("double"),
        },
    )
    q = exact_quantiles(df, columns, QUARTILES).select("column", (F.col("q3") - F.col("q1")).alias("iqr"))
    return base.join(q, "column", "left")


def distribution_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, median, corrected skew and kurtosis, quartiles per column."""
    base = per_column(
        df, columns, {"mean": lambda c: F.avg(c), "skew": corrected_skew, "kurtosis": corrected_kurtosis}
    )
    return base.join(exact_quantiles(df, columns, QUARTILES).drop("n"), "column", "left")


def grouped_mean_median(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per group and numeric column: count, mean, median."""
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(by), list(columns), "column", "x"
    )
    base = long.groupBy(*by, "column").agg(F.count("x").alias("n"), F.avg("x").alias("mean"))
    q = exact_quantiles(df, columns, {"median": 0.5}, by).drop("n")
    return join_null_safe(base, q, [*by, "column"], "left")


def _long_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value")
        .filter(F.col("value").isNotNull())
    )


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column as text, ties to the smallest; an aggregate, so no group is sorted."""
    counts = _long_strings(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("neg"), "value")).alias("b"))
    return best.select("column", F.col("b.value").alias("mode"), (-F.col("b.neg")).alias("n"))


def top_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = 5) -> DataFrame:
    """The ``k`` most frequent values per column with rank; ``rank <= k`` is applied before the shuffle too."""
    columns = list(columns or string_columns(df))
    counts = _long_strings(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))
    w = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def row_fingerprint(df: DataFrame, seed: int) -> Column:
    """64-bit hash of a row; a null is told from its neighbours' values."""
    return F.xxhash64(F.lit(seed), *[x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def count_duplicates(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier identical row: ``(n_rows, n_unique, n_duplicates)``. Rows meet under two 64-bit fingerprints."""
    per = df.select(row_fingerprint(df, 0).alias("a"), row_fingerprint(df, 1).alias("b")).groupBy("a", "b").agg(F.count("*").alias("n"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_unique"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"),
    )
