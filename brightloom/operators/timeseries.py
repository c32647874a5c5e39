"""Time-series operators. Ordered frames are cut into blocks, so a series may have any length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from brightloom.operators.ranking import framed, order_ranges, running_totals, split_row_number
from brightloom.session import written


def daily(df: DataFrame, ts: str, aggs: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """One row per day (and group): ``(*by, date, <aggs>)``."""
    return df.groupBy(*by, F.to_date(F.col(ts)).alias("date")).agg(*aggs)


def running_total(df: DataFrame, order: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Sum of ``value`` up to and with each row; ranges of the order carry the totals before them, so no series is one task."""
    ranged = order_ranges(written(df), order)
    added = F.coalesce(F.col(value), F.lit(0))
    seen = F.when(F.col(value).isNotNull(), 1).otherwise(0)
    out = running_totals(ranged, [F.asc(order)], F.col("__range"), {"__before": added, "__seen": seen}, by)
    total = F.coalesce("__before", F.lit(0)) + added
    any_value = F.coalesce("__seen", F.lit(0)) + seen > 0
    return out.withColumn("running_total", F.when(any_value, total)).drop("__range", "__before", "__seen")


def rolling_mean_std(df: DataFrame, order: str, value: str, by: Sequence[str] = (), size: int = 7) -> DataFrame:
    """Trailing mean and sample std over ``size`` rows, null until that many exist."""

    def columns(w: WindowSpec) -> dict[str, Column]:
        w = w.rowsBetween(-(size - 1), 0)
        full = F.count(value).over(w) == size
        return {"rolling_mean": F.when(full, F.avg(value).over(w)), "rolling_std": F.when(full, F.stddev_samp(value).over(w))}

    return framed(df, order, columns, before=size - 1, by=by)


def resample_month(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Month-end sum and mean of ``value``; months without rows are present (sum 0, mean null)."""
    monthly = df.groupBy(F.last_day(F.col(ts)).alias("month_end")).agg(
        F.sum(value).alias("total"), F.avg(value).alias("mean"), F.count(value).alias("n")
    )
    span = monthly.agg(F.trunc(F.min("month_end"), "month").alias("lo"), F.trunc(F.max("month_end"), "month").alias("hi"))
    calendar = span.select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("m")
    ).select(F.last_day("m").alias("month_end"))
    out = calendar.join(monthly, "month_end", "left")
    return out.select(
        "month_end", F.coalesce("total", F.lit(0.0)).alias("total"), "mean", F.coalesce("n", F.lit(0)).alias("n")
    )


def pct_change(df: DataFrame, order: str, value: str, name: str = "pct_change", by: Sequence[str] = ()) -> DataFrame:
    """Percent change to the previous row; null for the first row and after a zero."""

    def columns(w: WindowSpec) -> dict[str, Column]:
        prev = F.lag(value).over(w)
        return {name: F.when(prev != 0, (F.col(value) / prev - 1) * 100)}

    return framed(df, order, columns, before=1, by=by)


def context_window(
    df: DataFrame, flag: Column, order: Sequence[str], bucket: Column, key: str, by: Sequence[str], size: int = 10
) -> DataFrame:
    """Rows at positions ``[i - size, i + size)`` around every flagged row, as ``anomaly_id, offset, <row>``.

    Positions come from a split row number, then flagged rows meet their neighbours in an equi-join on the
    position, so no group is ever ordered in one task.
    """
    numbered = split_row_number(df, [F.asc(c) for c in order], bucket, by, "__pos")
    offsets = F.sequence(F.lit(-size), F.lit(size - 1))
    wanted = numbered.filter(flag).select(
        *by, F.col(key).alias("anomaly_id"), F.explode(offsets).alias("offset"), F.col("__pos").alias("__at")
    ).withColumn("__pos", F.col("__at") + F.col("offset")).drop("__at")
    return wanted.join(numbered, [*by, "__pos"]).drop("__pos")


def seasonal_decompose(df: DataFrame, order: str, value: str, period: int = 30) -> DataFrame:
    """Additive trend, seasonal and residual of a regular series (one row per period step).

    Trend is the centred moving average (for an even period with half weight on both ends), null at both
    ends; seasonal is the mean detrended value per phase, shifted to mean zero over the phases.
    """
    half = period // 2
    width = 2 * half + 1

    def trend(w: WindowSpec) -> dict[str, Column]:
        frame = w.rowsBetween(-half, half)
        total = F.sum(value).over(frame)
        if period % 2 == 0:
            total = total - (F.lag(value, half).over(w) + F.lead(value, half).over(w)) / 2
        return {"trend": F.when(F.count(value).over(frame) == width, total / period)}

    rows = framed(df, order, trend, before=half, after=half, position="__i")
    rows = rows.withColumn("__phase", F.col("__i") % period).withColumn("__detrended", F.col(value) - F.col("trend"))
    means = rows.groupBy("__phase").agg(F.avg("__detrended").alias("__m"))
    level = means.agg(F.avg("__m")).scalar()
    seasonal = means.select("__phase", (F.col("__m") - level).alias("seasonal"))
    out = rows.join(F.broadcast(seasonal), "__phase")  # exactly `period` rows
    return out.withColumn("residual", F.col(value) - F.col("trend") - F.col("seasonal")).drop(
        "__i", "__phase", "__detrended"
    )
