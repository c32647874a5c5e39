"""Group fairness of a binary outcome. Every metric is one conditional aggregation over whole rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.operators.profile import per_column
from brightloom.session import measured


def protected_groups(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """``(attribute, privileged, unprivileged)`` for two-valued attributes: the larger sorted value is privileged."""
    facts = per_column(
        df, attributes,
        {
            "low": lambda c: F.min(F.col(c).cast("string")), "high": lambda c: F.max(F.col(c).cast("string")),
        },
    )
    bounds = facts.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("low", "high"))))).scalar()
    long = df.select(*[F.col(a).cast("string").alias(a) for a in attributes]).unpivot([], list(attributes), "column", "v")
    b = F.element_at(bounds, F.col("column"))
    inner = long.filter(F.col("v").isNotNull()).groupBy("column").agg(
        F.bool_or((F.col("v") != b["low"]) & (F.col("v") != b["high"])).alias("more")
    )
    out = facts.join(inner, "column").filter(~F.col("more") & (F.col("low") != F.col("high")))
    return out.select(F.col("column").alias("attribute"), F.col("high").alias("privileged"), F.col("low").alias("unprivileged"))


def encode_protected(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Two-valued attributes as 1 (privileged) or 0; the rest untouched."""
    m = protected_groups(df, attributes).agg(F.map_from_entries(F.collect_list(F.struct("attribute", "privileged")))).scalar()
    new = {f"{a}_privileged": F.when(m[a].isNotNull() & F.col(a).isNotNull(), (F.col(a).cast("string") == m[a]).cast("int")) for a in attributes}
    return df.withColumns(new)


def _sides(attributes: Sequence[str]) -> tuple[Column, Column]:
    """A row belongs to a side when any of the 0/1 attributes matches it."""
    priv, unpriv = F.lit(False), F.lit(False)
    for a in attributes:
        priv = priv | F.coalesce(F.col(a) == 1, F.lit(False))
        unpriv = unpriv | F.coalesce(F.col(a) == 0, F.lit(False))
    return priv, unpriv


def _rate(side: Column, hit: Column, weight: Column) -> Column:
    """Weighted share of ``hit`` rows on a side; null for an empty side."""
    return F.try_divide(F.sum(F.when(side, F.when(hit, weight).otherwise(F.lit(0.0)))), F.sum(F.when(side, weight)))


def fairness_metrics(
    df: DataFrame, label: str, attributes: Sequence[str], weight: str | None = None, prediction: str | None = None
) -> DataFrame:
    """One row: rates of both sides, disparate impact, statistical parity difference and, given a prediction,
    equal opportunity difference. A side without rows gives null."""
    w = F.col(weight) if weight else F.lit(1.0)
    priv, unpriv = _sides(attributes)
    fav = F.col(label) == 1
    aggs = [_rate(unpriv, fav, w).alias("rate_unprivileged"), _rate(priv, fav, w).alias("rate_privileged")]
    if prediction:
        yes = F.col(prediction) == 1
        aggs += [_rate(unpriv & fav, yes, w).alias("tpr_unprivileged"), _rate(priv & fav, yes, w).alias("tpr_privileged")]
    out = df.agg(*aggs)
    out = out.withColumns(
        {
            "disparate_impact": F.try_divide("rate_unprivileged", "rate_privileged"),
            "statistical_parity_difference": F.col("rate_unprivileged") - F.col("rate_privileged"),
        }
    )
    if prediction:
        out = out.withColumn("equal_opportunity_difference", F.col("tpr_unprivileged") - F.col("tpr_privileged"))
    return out


def reweighing(df: DataFrame, label: str, group: str) -> DataFrame:
    """Add ``weight`` = P(group)·P(label) / P(group, label); null where group or label is null."""
    cells = df.filter(F.col(group).isNotNull() & F.col(label).isNotNull()).groupBy(group, label).agg(F.count("*").alias("__n"))
    cells = measured(cells)
    total = cells.agg(F.sum("__n")).scalar()
    by_g = cells.groupBy(group).agg(F.sum("__n").alias("__g"))
    by_y = cells.groupBy(label).agg(F.sum("__n").alias("__y"))
    table = cells.join(by_g, group).join(by_y, label)
    table = measured(table.select(group, label, (F.col("__g") * F.col("__y") / (total * F.col("__n"))).alias("weight")))
    return df.join(table, [group, label], "left")


def fairness_improvement(df: DataFrame, label: str, group: str) -> DataFrame:
    """``(metric, before, after, change)`` of the rate metrics without and with reweighing."""
    names = ["disparate_impact", "statistical_parity_difference"]
    before = fairness_metrics(df, label, [group]).select(*names).unpivot([], names, "metric", "before")
    after = fairness_metrics(reweighing(df, label, group), label, [group], "weight").select(*names).unpivot([], names, "metric", "after")
    return before.join(after, "metric").withColumn("change", F.col("after") - F.col("before"))
