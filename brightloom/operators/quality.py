"""Cleaning and data-quality operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightloom.functions.numeric import numeric_columns, string_columns
from brightloom.operators import profile
from brightloom.operators.ranking import exact_quantiles, with_stats
from brightloom.operators.relational import map_values
from brightloom.session import measured


def impute_mean_mode(
    df: DataFrame, numeric: Sequence[str] | None = None, other: Sequence[str] | None = None, fit_on: DataFrame | None = None
) -> DataFrame:
    """Numeric null -> column mean, other null -> most frequent value (ties to the smallest).

    Statistics come from ``fit_on`` (default: ``df``) as one-row scalar subqueries of the same plan.
    """
    numeric = numeric_columns(df) if numeric is None else list(numeric)
    other = string_columns(df) if other is None else list(other)
    src = df if fit_on is None else fit_on
    new, out = {}, df
    if numeric:
        out = with_stats(out, src.agg(F.struct(*[F.avg(c).alias(c) for c in numeric])), "__means")
        new |= {c: F.coalesce(F.col(c).cast("double"), F.col("__means")[c]) for c in numeric}
    if other:
        m = profile.modes(src, other)
        out = with_stats(out, m.agg(F.map_from_entries(F.collect_list(F.struct("column", "mode")))), "__modes")  # one entry per column
        new |= {c: F.coalesce(F.col(c), F.col("__modes")[c].cast(df.schema[c].dataType)) for c in other}
    return out.withColumns(new).drop("__means", "__modes")


def _deletions(word: Column, depth: int) -> Column:
    """All strings obtained by deleting at most ``depth`` characters."""
    out = F.array(word)
    for _ in range(depth):
        out = F.array_distinct(
            F.flatten(
                F.transform(
                    out,
                    lambda w: F.concat(
                        F.array(w),
                        F.when(
                            F.length(w) > 0,
                            F.transform(
                                F.sequence(F.lit(1), F.length(w)),
                                lambda i: F.concat(w.substr(F.lit(1), i - 1), w.substr(i + 1, F.length(w))),
                            ),
                        ).otherwise(F.array().cast("array<string>")),
                    ),
                )
            )
        )
    return out


def propose_corrections(df: DataFrame, c: str, max_dist: int = 1, min_ratio: float = 2.0) -> DataFrame:
    """``(old, new, n, distance)``: each rare value with the most frequent value within ``max_dist`` edits that
    occurs at least ``min_ratio`` times as often (ties to the smallest).

    Works on distinct values. Two strings within distance d share a string reachable by at most d deletions
    from each, so candidates meet in an equi-join on such strings and no block of values is compared in full.
    """
    counts = measured(df.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("v")).agg(F.count("*").alias("n")))
    variants = F.explode(_deletions(F.col("v"), max_dist)).alias("k")
    wrong = counts.select("v", "n", variants).alias("a")
    right = counts.filter(F.col("n") >= min_ratio).select("v", "n", variants).alias("b")  # no rarer value can be a correction
    near = wrong.join(right, (F.col("a.k") == F.col("b.k")) & (F.col("b.n") >= F.col("a.n") * min_ratio)).select(
        F.col("a.v").alias("old"), F.col("a.n").alias("n"), F.col("b.v").alias("new"), F.col("b.n").alias("new_n"),
        F.levenshtein(F.col("a.v"), F.col("b.v")).alias("distance"),
    )
    near = near.filter((F.col("distance") <= max_dist) & (F.col("old") != F.col("new")))
    best = near.groupBy("old", "n").agg(F.min(F.struct((-F.col("new_n")).alias("k"), "new", "distance")).alias("b"))
    return best.select("old", F.col("b.new").alias("new"), "n", F.col("b.distance").alias("distance"))


def typo_correction(df: DataFrame, c: str, max_dist: int = 1, min_ratio: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """``(corrected rows, log of applied corrections)``."""
    log = measured(propose_corrections(df, c, max_dist, min_ratio))
    return map_values(df, c, log.select("old", "new")), log


def value_pattern(c: Column) -> Column:
    """Shape of a text: runs of digits -> 9, runs of letters -> A."""
    return F.regexp_replace(F.regexp_replace(c, "[A-Za-z]+", "A"), "[0-9]+", "9")


def column_anomaly_report(df: DataFrame, rare_share: float = 0.05, k: float = 1.5) -> DataFrame:
    """``(column, check, item, n, share, suspicious)``: value shapes of string columns, interquartile sides of
    numeric ones. Rare shapes and values beyond the fences are suspicious."""
    strings, numbers = string_columns(df), numeric_columns(df)
    parts = []
    if strings:
        long = df.select(*strings).unpivot([], strings, "column", "v").filter(F.col("v").isNotNull())
        shapes = long.groupBy("column", value_pattern(F.col("v")).alias("item")).agg(F.count("*").alias("n"))
        parts.append(shapes.withColumn("check", F.lit("pattern")))
    if numbers:
        q = exact_quantiles(df, numbers, profile.QUARTILES)
        fences = q.agg(
            F.map_from_entries(
                F.collect_list(
                    F.struct(
                        "column",
                        F.struct(
                            (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lo"),
                            (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("hi"),
                        ),
                    )
                )
            )
        )  # one entry per column
        long = df.select(*[F.col(c).cast("double").alias(c) for c in numbers]).unpivot([], numbers, "column", "v")
        long = with_stats(long, fences).withColumn("__f", F.element_at("__s", F.col("column")))
        f = F.col("__f")
        side = F.when(F.col("v") < f["lo"], "low").when(F.col("v") > f["hi"], "high").otherwise("inside")
        sides = long.filter(F.col("v").isNotNull()).groupBy("column", side.alias("item")).agg(F.count("*").alias("n"))
        parts.append(sides.withColumn("check", F.lit("iqr")))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    total = out.groupBy("column", "check").agg(F.sum("n").alias("__t"))
    out = out.join(total, ["column", "check"]).withColumn("share", F.col("n") / F.col("__t")).drop("__t")
    bad = F.when(F.col("check") == "pattern", F.col("share") < rare_share).otherwise(F.col("item") != "inside")
    return out.withColumn("suspicious", bad).select("column", "check", "item", "n", "share", "suspicious")


def cleaning_log(df: DataFrame, changes: Mapping[tuple[str, str], tuple[Column, Column]]) -> DataFrame:
    """``(step, column, n_changed)`` from ``{(step, column): (old, new)}``, one pass."""
    rows = [
        F.struct(
            F.lit(step).alias("step"), F.lit(c).alias("column"), F.count_if(~old.eqNullSafe(new)).alias("n_changed")
        )
        for (step, c), (old, new) in changes.items()
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def clean_dataset(
    df: DataFrame, strings: Sequence[str] | None = None, numeric: Sequence[str] | None = None, max_dist: int = 1
) -> DataFrame:
    """Fix typos of the string columns, then fill nulls with mean or mode."""
    strings = string_columns(df) if strings is None else list(strings)
    numeric = numeric_columns(df) if numeric is None else list(numeric)
    out = df
    for c in strings:
        out, _ = typo_correction(out, c, max_dist)
    return impute_mean_mode(out, numeric, strings)


def clean_and_report(
    df: DataFrame, strings: Sequence[str] | None = None, numeric: Sequence[str] | None = None, max_dist: int = 1
) -> tuple[DataFrame, DataFrame]:
    """The cleaned table, and what is still suspicious in the cleaned columns (see ``column_anomaly_report``).

    The cleaned table is written once, as the report reads it too.
    """
    clean = measured(clean_dataset(df, strings, numeric, max_dist))
    strings = string_columns(df) if strings is None else list(strings)
    numeric = numeric_columns(df) if numeric is None else list(numeric)
    return clean, column_anomaly_report(clean.select(*strings, *numeric))


def data_quality_metrics(df: DataFrame, k: int = 5) -> DataFrame:
    """Long table ``(column, metric, item, value)``: row and duplicate counts, nulls, numeric mean/std/min/max,
    string distinct counts and most frequent values."""
    numbers, strings = numeric_columns(df), string_columns(df)
    rows = [("*", "row_count", F.count(F.lit(1)))]
    rows += [(c, "null_count", F.count_if(F.col(c).isNull())) for c in df.columns]
    for c in numbers:
        rows += [(c, "mean", F.avg(c)), (c, "std", F.stddev_samp(c)), (c, "min", F.min(c)), (c, "max", F.max(c))]
    wide = df.agg(*[v.cast("double").alias(f"v{i}") for i, (_, _, v) in enumerate(rows)])
    none = F.lit(None).cast("string")
    out = wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"), F.lit(m).alias("metric"), none.alias("item"), F.col(f"v{i}").alias("value")
                    )
                    for i, (c, m, _) in enumerate(rows)
                ]
            )
        )
    )
    dup = profile.count_duplicates(df).select(
        F.lit("*").alias("column"), F.lit("duplicate_rows").alias("metric"), none.alias("item"),
        F.col("n_duplicates").cast("double").alias("value"),
    )
    out = out.unionByName(dup)
    if strings:
        uniq = profile.count_distinct(df, strings).select(
            "column", F.lit("unique_count").alias("metric"), none.alias("item"), F.col("n_unique").cast("double").alias("value")
        )
        top = profile.top_values(df, strings, k).select(
            "column", F.lit("top_value").alias("metric"), F.col("value").alias("item"), F.col("n").cast("double").alias("value")
        )
        out = out.unionByName(uniq).unionByName(top)
    return out


TIME_WORDS = ("date", "time", "year", "month")  # fixed values: name parts that mark a time column


def dataset_overview(df: DataFrame) -> DataFrame:
    """``(column, dtype, kind, is_temporal, n_missing, n_unique)``: one pass for missing and one for distinct values."""
    stats = profile.missing_counts(df).join(profile.count_distinct(df, df.columns), "column")

    def kind(t: T.DataType) -> str:
        if isinstance(t, T.NumericType):
            return "numeric"
        return "categorical" if isinstance(t, T.StringType) else "other"

    info = F.create_map(
        *[
            x
            for f in df.schema.fields
            for x in (
                F.lit(f.name),
                F.struct(
                    F.lit(f.dataType.simpleString()).alias("dtype"), F.lit(kind(f.dataType)).alias("kind"),
                    F.lit(
                        any(w in f.name.lower() for w in TIME_WORDS)
                        or isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
                    ).alias("is_temporal"),
                ),
            )
        ]
    )
    d = info[F.col("column")]
    return stats.select(
        "column", d["dtype"].alias("dtype"), d["kind"].alias("kind"), d["is_temporal"].alias("is_temporal"), "n_missing", "n_unique"
    )


def target_profile(df: DataFrame, target: str) -> DataFrame:
    """``(item, value)``: rows, features, task kind, missing and categorical flags, and the share per class."""
    features = [c for c in df.columns if c != target]
    has_cat = any(c in features for c in string_columns(df))
    any_null = F.lit(False)
    for c in df.columns:
        any_null = any_null | F.col(c).isNull()
    facts = {
        "n_rows": F.count("*").cast("string"), "n_features": F.lit(str(len(features))),
        "task": F.when(F.count_distinct(target) == 2, "binary").otherwise("multiclass"),
        "has_missing": F.coalesce(F.bool_or(any_null), F.lit(False)).cast("string"),
        "has_categorical": F.lit(str(has_cat).lower()),
    }
    head = df.agg(*[v.alias(k) for k, v in facts.items()]).unpivot([], list(facts), "item", "value")
    balance = profile.value_counts(df, target).select(
        F.concat(F.lit("class_"), F.col(target).cast("string")).alias("item"), F.round("share", 6).cast("string").alias("value")
    )
    return head.unionByName(balance)
