"""Exploratory tables: what a chart of the data needs, computed in aggregation passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.functions.numeric import numeric_columns, string_columns
from brightloom.operators import profile
from brightloom.operators.ranking import exact_quantiles, join_null_safe, with_stats
from brightloom.session import measured


def histogram_bins(df: DataFrame, c: str, bins: int | None = 20) -> DataFrame:
    """Equal-width bins ``(bin, lo, hi, n)`` including empty ones; the last bin is closed.

    ``bins=None`` picks the larger of the Sturges and Freedman-Diaconis counts.
    """
    x = F.col(c).cast("double")
    facts = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"))
    if bins is None:
        q = exact_quantiles(df, [c], profile.QUARTILES).select((F.col("q3") - F.col("q1")).alias("iqr"))
        iqr = q.scalar()
        fd = 2 * iqr / F.pow(F.col("n").cast("double"), F.lit(1 / 3))
        spread = F.col("hi") - F.col("lo")
        sturges = F.ceil(F.log2(F.col("n").cast("double")) + 1)
        facts = facts.withColumn("k", F.greatest(sturges, F.coalesce(F.when(fd > 0, F.ceil(spread / fd)), sturges)).cast("int"))
    else:
        facts = facts.withColumn("k", F.lit(bins))
    stats = facts.select(F.struct("lo", "k", ((F.col("hi") - F.col("lo")) / F.col("k")).alias("w")).alias("s"))
    one = F.col("__s")
    spine = facts.select(
        F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("bin"), "lo", ((F.col("hi") - F.col("lo")) / F.col("k")).alias("w")
    )
    at = F.when(one["w"] > 0, F.least(F.floor((x - one["lo"]) / one["w"]), one["k"] - 1)).otherwise(F.lit(0)).cast("int")
    counts = with_stats(df.filter(x.isNotNull()), stats).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    out = spine.join(counts, "bin", "left")
    lo = F.col("lo") + F.col("bin") * F.col("w")
    return out.select("bin", lo.alias("lo"), (lo + F.col("w")).alias("hi"), F.coalesce("n", F.lit(0)).alias("n"))


def grouped_histogram(df: DataFrame, c: str, by: str) -> DataFrame:
    return df.groupBy(c, by).agg(F.count("*").alias("n"))


def box_plot_stats(df: DataFrame, by: str, c: str, k: float = 1.5) -> DataFrame:
    """Per category: n, min, quartiles, max, fences and the number of values beyond them."""
    q = exact_quantiles(df, [c], {"lowest": 0.0, **profile.QUARTILES, "highest": 1.0}, [by]).drop("column")
    iqr = F.col("q3") - F.col("q1")
    q = measured(q.withColumns({"lower_fence": F.col("q1") - k * iqr, "upper_fence": F.col("q3") + k * iqr}))
    x = F.col(c).cast("double")
    beyond = (
        join_null_safe(df.select(by, x.alias("__x")), q.select(by, "lower_fence", "upper_fence"), [by])
        .filter((F.col("__x") < F.col("lower_fence")) | (F.col("__x") > F.col("upper_fence")))
        .groupBy(by).agg(F.count("*").alias("n_outliers"))
    )
    out = join_null_safe(q, beyond, [by], "left")
    return out.withColumn("n_outliers", F.coalesce("n_outliers", F.lit(0)))


def xy_sum(df: DataFrame, x: Column, y: str) -> DataFrame:
    """Bar or line data: summed ``y`` per ``x``, ordered by ``x``."""
    return df.groupBy(x.alias("x")).agg(F.sum(y).alias("y")).orderBy("x")


def hash_sample(df: DataFrame, key: str, hex_digits: int = 1) -> DataFrame:
    """Repeatable sample of about ``16**-hex_digits`` of the rows, chosen by the md5 of the key."""
    return df.filter(F.md5(F.col(key).cast("string")).startswith("0" * hex_digits))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long Pearson matrix ``(a, b, r)`` over all ordered pairs, pairwise-complete, one pass."""
    columns = list(columns or numeric_columns(df))
    pairs = list(combinations(columns, 2))
    row = df.agg(
        *[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)], F.count("*").alias("n")
    )
    cells = [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("r")) for c in columns]
    for i, (a, b) in enumerate(pairs):
        r = F.col(f"r{i}")
        cells += [
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r")),
            F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), r.alias("r")),
        ]
    return row.select(F.inline(F.array(*cells)))


def strong_correlations(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """Pairs ``a`` before ``b`` in column order whose absolute correlation exceeds ``threshold``."""
    columns = list(columns or numeric_columns(df))
    rank = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))])
    m = correlation_matrix(df, columns)
    return m.filter((rank[F.col("a")] < rank[F.col("b")]) & (F.abs("r") > threshold))


def categorical_numeric_relations(
    df: DataFrame, categories: Sequence[str] | None = None, numbers: Sequence[str] | None = None
) -> DataFrame:
    """``(category, level, column, n, mean, median)`` for every categorical × numeric pair, no job per pair."""
    categories = list(categories or string_columns(df))
    numbers = list(numbers or numeric_columns(df))
    long = df.select(*categories, *numbers).unpivot(list(numbers), categories, "category", "level")
    return profile.grouped_mean_median(long.filter(F.col("level").isNotNull()), ["category", "level"], numbers)


def data_profile(df: DataFrame, k: int = 5) -> DataFrame:
    """Whole-table profile ``(section, column, item, value)``."""
    none = F.lit(None).cast("string")
    stats = profile.describe_numeric(df)
    names = [c for c in stats.columns if c != "column"]
    parts = [
        stats.select("column", *[F.col(c).cast("double").alias(c) for c in names])
        .unpivot("column", names, "item", "value")
        .select(F.lit("describe").alias("section"), "column", "item", "value"),
        profile.missing_counts(df).select(F.lit("missing").alias("section"), "column", none.alias("item"), F.col("n_missing").cast("double").alias("value")),
        profile.count_distinct(df, df.columns).select(F.lit("distinct").alias("section"), "column", none.alias("item"), F.col("n_unique").cast("double").alias("value")),
    ]
    if string_columns(df):
        parts.append(
            profile.top_values(df, k=k).select(F.lit("top").alias("section"), "column", F.col("value").alias("item"), F.col("n").cast("double").alias("value"))
        )
    if len(numeric_columns(df)) > 1:
        parts.append(correlation_matrix(df).select(F.lit("correlation").alias("section"), F.col("a").alias("column"), F.col("b").alias("item"), F.col("r").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report_context(df: DataFrame, ts: str | None = None, methods: Mapping[str, Column] | None = None) -> DataFrame:
    """Facts a report starts from, ``(section, item, value)``: sizes, time range, per-column range and mean, flagged rows per method."""
    facts = [("size", "n_rows", F.count("*").cast("string")), ("size", "n_columns", F.lit(str(len(df.columns))))]
    if ts:
        facts += [("time", "first", F.min(ts).cast("string")), ("time", "last", F.max(ts).cast("string"))]
    for c in numeric_columns(df):
        x = F.col(c).cast("double")
        facts += [
            ("range", f"{c}_min", F.round(F.min(x), 4).cast("string")), ("range", f"{c}_max", F.round(F.max(x), 4).cast("string")),
            ("mean", c, F.round(F.avg(x), 4).cast("string")),
        ]
    facts += [("missing", c, F.count_if(F.col(c).isNull()).cast("string")) for c in df.columns]
    facts += [("method", name, F.count_if(flag).cast("string")) for name, flag in (methods or {}).items()]
    row = df.agg(*[v.alias(f"v{i}") for i, (_, _, v) in enumerate(facts)])
    cells = [
        F.struct(F.lit(s).alias("section"), F.lit(i).alias("item"), F.col(f"v{j}").alias("value")) for j, (s, i, _) in enumerate(facts)
    ]
    return row.select(F.inline(F.array(*cells)))
