"""KPI series and their statistics. A KPI table is long: ``(kpi, date, value)``, one row per period."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.operators.timeseries import daily, pct_change, resample_month, rolling_mean_std
from brightloom.session import measured, written


def daily_sales(df: DataFrame, ts: str, value: str) -> DataFrame:
    return daily(df, ts, [F.sum(value).alias("sales")])


def sales_ma_7d(df: DataFrame, ts: str, value: str) -> DataFrame:
    """7-row mean of daily sales (rows, not calendar days)."""
    out = rolling_mean_std(daily_sales(df, ts, value), "date", "sales", size=7)
    return out.select("date", F.col("rolling_mean").alias("sales_ma_7d"))


def mom_growth(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Percent change of monthly sums, at month end."""
    return pct_change(resample_month(df, ts, value), "month_end", "total", "growth").select(
        "month_end", "total", "growth"
    )


def daily_active(df: DataFrame, ts: str, user: str) -> DataFrame:
    return daily(df, ts, [F.count_distinct(user).alias("active_users")])


def retention_rate(df: DataFrame, ts: str, user: str) -> DataFrame:
    """Per month the percentage of distinct users seen at least twice in it; 0 for months without rows."""
    seen = df.groupBy(F.last_day(F.col(ts)).alias("month_end"), user).agg(F.count("*").alias("__n"))
    rate = seen.groupBy("month_end").agg((F.avg((F.col("__n") >= 2).cast("double")) * 100).alias("rate"))
    span = rate.agg(F.trunc(F.min("month_end"), "month").alias("lo"), F.trunc(F.max("month_end"), "month").alias("hi"))
    months = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("m"))
    calendar = months.select(F.last_day("m").alias("month_end"))
    return calendar.join(rate, "month_end", "left").select("month_end", F.coalesce("rate", F.lit(0.0)).alias("retention_rate"))


def order_kpis(df: DataFrame, ts: str, value: str, user: str) -> DataFrame:
    """The five KPIs of a sales table, long: daily sales, their 7-day mean, monthly growth, daily active users, retention.

    All are derived from one aggregate per day and user; the daily rows are written once.
    """
    base = df.groupBy(F.to_date(F.col(ts)).alias("date"), F.col(user).alias("user")).agg(F.sum(value).alias("sales"), F.count("*").alias("n"))
    per_day = measured(base.groupBy("date").agg(F.sum("sales").alias("sales"), F.count("user").cast("double").alias("active")))
    smooth = rolling_mean_std(per_day, "date", "sales", size=7).select("date", "rolling_mean")
    growth = written(pct_change(resample_month(per_day, "date", "sales"), "month_end", "total", "growth").select("month_end", "growth"))
    per_month = base.filter(F.col("user").isNotNull()).groupBy(F.last_day("date").alias("date"), "user").agg(F.sum("n").alias("n"))
    kept = per_month.groupBy("date").agg((F.avg((F.col("n") >= 2).cast("double")) * 100).alias("rate"))
    # as for growth, months without rows are there: nobody came back in them
    kept = growth.select(F.col("month_end").alias("date")).join(kept, "date", "left").select("date", F.coalesce("rate", F.lit(0.0)).alias("rate"))
    return long_kpis(
        {"daily_sales": per_day.select("date", "sales"), "sales_ma_7d": smooth, "mom_growth": growth, "daily_active": per_day.select("date", "active"), "retention_rate": kept}
    )


def long_kpis(series: dict[str, DataFrame]) -> DataFrame:
    """Stack ``(date, value)`` frames (first column the date) into the long KPI table, nulls left out."""
    out = None
    for name, df in series.items():
        d, v = df.columns[:2]
        part = df.select(F.lit(name).alias("kpi"), F.col(d).alias("date"), F.col(v).cast("double").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out.filter(F.col("value").isNotNull())


def kpi_trend_stats(kpis: DataFrame, last: int = 7) -> DataFrame:
    """Per KPI: current, previous, change %, mean, sample std, last values (oldest first).

    The newest points are a top-n that is cut in the tasks first; no series is ordered as a whole.
    """
    kpis = measured(kpis)
    stats = kpis.groupBy("kpi").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.count("*").alias("n"))
    newest = kpi_recent(kpis, max(last, 2)).groupBy("kpi").agg(
        F.max(F.when(F.col("rank") == 1, F.col("value"))).alias("current"),
        F.max(F.when(F.col("rank") == 2, F.col("value"))).alias("previous"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("rank") <= last, F.struct("date", "value")))), lambda s: s["value"]).alias("last_values"),
    )
    out = stats.join(newest, "kpi")
    return out.withColumn("change_pct", F.when(F.col("previous") != 0, (F.col("current") / F.col("previous") - 1) * 100))


def kpi_recent(kpis: DataFrame, n: int = 30) -> DataFrame:
    """The last ``n`` points of every KPI with rank 1 = newest."""
    w = Window.partitionBy("kpi").orderBy(F.desc("date"))
    return kpis.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def kpi_correlations(kpis: DataFrame, names: list[str]) -> DataFrame:
    """Pearson correlation of every KPI pair over the dates both have."""
    wide = kpis.groupBy("date").pivot("kpi", names).agg(F.first("value"))
    pairs = list(combinations(names, 2))
    row = wide.agg(
        *[
            F.struct(
                F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(a, b).alias("r"),
                F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).alias("n"),
            ).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return row.select(F.inline(F.array(*[f"p{i}" for i in range(len(pairs))])))


# Seasonal lengths in days and the number of sine and cosine pairs for each.
SEASONS = ((7.0, 3), (365.25, 5))


def _design(day: Column, span: Column) -> Column:
    """Constant, trend and seasonal terms of a day; a season counts where the series covers it twice."""
    terms = [F.lit(1.0), day / span]
    for length, order in SEASONS:
        for k in range(1, order + 1):
            turn = day * (2 * math.pi * k / length)
            terms += [F.when(span >= 2 * length, f(turn)).otherwise(F.lit(0.0)) for f in (F.sin, F.cos)]
    return F.array(*terms)


# Candidate change points, the share of the history that they cover, and the scale of a slope change that is expected.
CANDIDATES, COVERED, EXPECTED = 25, 0.8, 0.05
_FINE = 8  # positions tried on either side of a change found among the candidates
_BASE = 2 + 2 * sum(order for _, order in SEASONS)


def _with_hinges(x: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """The terms ``x`` and one more per knot: how far the trend's time lies behind it."""
    return np.hstack([x, np.maximum(x[:, 1:2] - knots[None, :], 0)])


def _gram(rows: DataFrame) -> DataFrame:
    """``(kpi, m)``: products of all pairs of terms, hinges at ``knots`` and value, summed over the rows ``(kpi, x, value, knots)``."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}

        def done() -> pd.DataFrame:
            return pd.DataFrame({"kpi": list(sums), "m": [m.ravel() for m in sums.values()]})

        for f in frames:
            for name, g in f.groupby("kpi"):
                z = np.column_stack([_with_hinges(np.stack(g["x"].to_numpy()), np.asarray(g["knots"].iloc[0], float)), g["value"].to_numpy(float)])
                sums[name] = sums.get(name, 0) + z.T @ z
            if len(sums) > 1000:
                yield done()
                sums.clear()
        if sums:
            yield done()

    parts = rows.select("kpi", "x", "value", "knots").mapInPandas(partial, "kpi string, m array<double>")
    total = parts.select("kpi", F.posexplode("m").alias("at", "v")).groupBy("kpi", "at").agg(F.sum("v").alias("v"))
    return total.groupBy("kpi").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda s: s["v"]).alias("m"))


def _least_squares(m: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, float]:
    """Coefficients of the terms ``use`` and the squared error, from the products ``m`` (value last)."""
    coef = np.linalg.lstsq(m[np.ix_(use, use)], m[use, -1], rcond=1e-12)[0]
    return coef, max(float(m[-1, -1] - coef @ m[use, -1]), 0.0)


def sparse_changes(m: np.ndarray, n: int, sweeps: int = 500) -> np.ndarray:
    """Slope changes at the candidates: least squares with an absolute penalty on them, by coordinate descent.

    The penalty is the noise variance over the expected size of a change, for values scaled to 1. ``m`` has the base terms first.
    """
    p = len(m) - 1
    scale = np.sqrt(m[-1, -1] / max(n, 1)) or 1.0
    a, c = m[:p, :p], m[:p, -1] / scale
    full, error = _least_squares(m, np.arange(p))
    penalty = np.where(np.arange(p) < _BASE, 0.0, error / scale**2 / max(n - p, 1) / EXPECTED)
    b = np.zeros(p)
    left = c.copy()
    size = np.diag(a)
    for _ in range(sweeps):
        moved = 0.0
        for j in np.flatnonzero(size > 1e-9):
            rho = left[j] + size[j] * b[j]
            new = np.sign(rho) * max(abs(rho) - penalty[j], 0.0) / size[j]
            if new != b[j]:
                left -= a[:, j] * (new - b[j])
                moved = max(moved, abs(new - b[j]))
                b[j] = new
        if moved < 1e-7:
            break
    return b[_BASE:] * scale


def change_places(m: np.ndarray, knots: np.ndarray, n: int) -> list[float]:
    """Middle of every run of neighbouring candidates whose slopes change in one direction."""
    use = np.unique(np.linspace(0, len(knots) - 1, min(len(knots), n // 8)).astype(int)) if n >= 16 else np.zeros(0, int)
    if not len(use):
        return []
    keep = np.r_[np.arange(_BASE), _BASE + use, len(m) - 1]
    found = sparse_changes(m[np.ix_(keep, keep)], n)
    runs: list[list[int]] = []
    for i in np.flatnonzero(np.abs(found) > 1e-6 * max(np.abs(found).max(), 1e-300)):
        if runs and runs[-1][-1] == i - 1 and found[i - 1] * found[i] > 0:
            runs[-1].append(i)
        else:
            runs.append([i])
    return [float(np.average(knots[use[r]], weights=np.abs(found[r]))) for r in runs]


def place_changes(m: np.ndarray, groups: list[list[int]], n: int, select: bool) -> tuple[list[int], np.ndarray, float]:
    """One knot per group of positions: ``(chosen positions, coefficients of base terms and knots, squared error)``.

    Positions are improved in turn until no move lowers the error. With ``select`` a change stays only if it lowers ``n log(error)``
    by more than three times ``log(n)``: once for its slope and twice for its place, which is searched for.
    """
    base = np.arange(_BASE)

    def fit(chosen: list[int]) -> tuple[np.ndarray, float]:
        return _least_squares(m, np.r_[base, _BASE + np.array(chosen, int)])

    chosen = [g[len(g) // 2] for g in groups]
    groups = list(groups)
    floor = 1e-12 * m[-1, -1] + 1e-300
    while True:
        best = fit(chosen)[1]
        for _ in range(10):
            before = best
            for i, g in enumerate(groups):
                errors = [fit([*chosen[:i], p, *chosen[i + 1 :]])[1] for p in g]
                if min(errors) < best:
                    best, chosen[i] = min(errors), g[int(np.argmin(errors))]
            if before - best <= 1e-9 * before:
                break
        without = [fit(chosen[:i] + chosen[i + 1 :])[1] for i in range(len(chosen))]
        if not chosen or not select or n * np.log((min(without) + floor) / (best + floor)) > 3 * np.log(n):
            return chosen, *fit(chosen)
        drop = int(np.argmin(without))
        del chosen[drop], groups[drop]


def future_trend(changes: np.ndarray, span: float, periods: int, seed: int, share: float, paths: int = 2000) -> np.ndarray:
    """``(2, periods)``: lower and upper quantile of what slope changes to come add to the trend.

    Changes come as often as in the history, with Laplace sizes of the mean size there; none were seen, none are to come.
    """
    if not len(changes):
        return np.zeros((2, periods))
    rng = np.random.default_rng(seed)
    sizes = rng.laplace(0.0, np.abs(changes).mean(), (paths, periods)) * (rng.random((paths, periods)) < len(changes) / max(span, 1.0))
    added = np.cumsum(np.cumsum(sizes, axis=1), axis=1) / span
    return np.quantile(added, [share, 1 - share], axis=0)


def kpi_forecast(kpis: DataFrame, periods: int = 30, z: float = 1.96, seed: int = 42) -> DataFrame:
    """Trend with change points and weekly and yearly seasons of every KPI: ``(kpi, date, actual, forecast, lower, upper, changes)``.

    Fitted history rows and ``periods`` days ahead (``actual`` null). Slopes may change at 25 candidates over the first 80 % of the
    history (fewer for less than 200 rows); an absolute penalty selects them, then each is placed more finely and stays only if it
    pays, and all terms are fitted by least squares. Spark sums the products of terms of all KPIs, per task and then per KPI,
    once for the candidates and once for each finer step, down to half a day; what is solved per KPI has a bounded size. Bounds of the history are
    ``z`` standard errors wide; ahead, the spread of simulated future slope changes adds to them. ``changes`` holds the dates.
    """
    kpis = measured(kpis)  # one row per period, read by several steps
    ends = kpis.groupBy("kpi").agg(F.min("date").alias("start"), F.max("date").alias("stop"), F.count("value").alias("n"))
    ends = measured(ends.withColumn("span", F.greatest(F.date_diff("stop", "start"), F.lit(1)).cast("double")))
    rows = kpis.join(ends, "kpi").withColumn("x", _design(F.date_diff("date", "start").cast("double"), F.col("span")))
    coarse = np.linspace(0, COVERED, CANDIDATES + 1)[1:]
    # each round tries positions an eighth as far apart, down to half a day in the longest series
    longest = ends.agg(F.max("span")).first()[0] or 1.0
    steps = [float(coarse[0]) / _FINE]
    while steps[-1] * longest > 0.5:
        steps.append(steps[-1] / _FINE)

    def grid(places: np.ndarray, step: float) -> np.ndarray:
        return np.maximum(np.asarray(places, float)[:, None] + step * np.arange(-_FINE, _FINE + 1), 0.0).ravel()

    def placed(m: np.ndarray, places: np.ndarray, step: float, n: int, select: bool) -> tuple:
        """Knots, coefficients, squared error and the number of terms used."""
        knots = grid(places, step)
        size = _BASE + len(knots) + 1
        square = np.asarray(m).reshape(size, size)
        groups = [list(range(i, i + 2 * _FINE + 1)) for i in range(0, len(knots), 2 * _FINE + 1)]
        chosen, coef, error = place_changes(square, groups, n, select)
        return knots[chosen], coef, error, int((np.diag(square)[:_BASE] > 0).sum()) + 2 * len(chosen)

    @F.pandas_udf("array<double>")
    def search(m: pd.Series, n: pd.Series) -> pd.Series:
        size = _BASE + CANDIDATES + 1
        return pd.Series([change_places(np.asarray(a).reshape(size, size), coarse, int(k)) for a, k in zip(m, n)])

    def products(places: DataFrame, step: float) -> DataFrame:
        knots = F.flatten(F.transform("places", lambda c: F.array(*[F.greatest(c + i * step, F.lit(0.0)) for i in range(-_FINE, _FINE + 1)])))
        return _gram(rows.join(places, "kpi").withColumn("knots", knots)).join(places, "kpi").join(ends, "kpi")

    first = _gram(rows.withColumn("knots", F.array(*[F.lit(float(k)) for k in coarse])))
    places = measured(first.join(ends.select("kpi", "n"), "kpi").select("kpi", search("m", "n").alias("places")))

    def closer(step: float) -> Callable:
        @F.pandas_udf("array<double>")
        def move(m: pd.Series, at: pd.Series, n: pd.Series) -> pd.Series:
            return pd.Series([placed(a, p, step, int(k), False)[0] for a, p, k in zip(m, at, n)])

        return move

    for step in steps[:-1]:
        places = measured(products(places, step).select("kpi", closer(step)("m", "places", "n").alias("places")))

    @F.pandas_udf("struct<coef:array<double>,knots:array<double>,sd:double,low:array<double>,high:array<double>>")
    def solve(name: pd.Series, m: pd.Series, at: pd.Series, n: pd.Series, span: pd.Series) -> pd.DataFrame:
        out = []
        for kpi, a, p, count, days in zip(name, m, at, n, span):
            knots, coef, error, used = placed(a, p, steps[-1], int(count), True)
            low, high = future_trend(coef[_BASE:], days, periods, zlib.crc32(f"{seed}:{kpi}".encode()), math.erfc(z / math.sqrt(2)) / 2)
            out.append((coef, knots, math.sqrt(error / max(count - used, 1)), low, high))
        return pd.DataFrame(out, columns=["coef", "knots", "sd", "low", "high"])

    joined = products(places, steps[-1])
    solved = measured(joined.select("kpi", "start", "stop", "span", solve("kpi", "m", "places", "n", "span").alias("fit")).select("kpi", "start", "stop", "span", "fit.*"))
    solved = solved.withColumn("changes", F.transform("knots", lambda k: F.date_add("start", F.round(k * F.col("span")).cast("int"))))
    hinges = F.transform("knots", lambda k: F.greatest(F.element_at("x", 2) - k, F.lit(0.0)))
    value = F.aggregate(F.zip_with(F.concat("x", hinges), "coef", lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
    model = solved.select("kpi", "coef", "knots", "sd", "changes")
    fitted = rows.select("kpi", "date", F.col("value").alias("actual"), "x").join(model, "kpi")
    fitted = fitted.select("kpi", "date", "actual", value.alias("forecast"), F.lit(0.0).alias("low"), F.lit(0.0).alias("high"), "sd", "changes")
    days = F.posexplode(F.sequence(F.date_add("stop", 1), F.date_add("stop", periods)))
    ahead = solved.select("*", days.alias("i", "date")).withColumn("x", _design(F.date_diff("date", "start").cast("double"), F.col("span")))
    ahead = ahead.select("kpi", "date", F.lit(None).cast("double").alias("actual"), value.alias("forecast"), F.get("low", "i").alias("low"), F.get("high", "i").alias("high"), "sd", "changes")
    out = fitted.unionByName(ahead)
    return out.select(
        "kpi", "date", "actual", "forecast", (F.col("forecast") + F.col("low") - z * F.col("sd")).alias("lower"), (F.col("forecast") + F.col("high") + z * F.col("sd")).alias("upper"), "changes"
    )


def kpi_rules(stats: DataFrame, drop_pct: float = 10.0, sigmas: float = 2.0) -> DataFrame:
    """Add ``dropped`` (fell by more than ``drop_pct`` %), ``unusual`` (outside mean ± sigmas·std) and ``advice``."""
    dropped = F.coalesce(F.col("change_pct") < -drop_pct, F.lit(False))
    unusual = F.coalesce(F.abs(F.col("current") - F.col("mean")) > sigmas * F.col("std"), F.lit(False))
    advice = (
        F.when(dropped & unusual, "investigate now").when(dropped, "watch drop").when(unusual, "check level").otherwise("ok")
    )
    return stats.withColumns({"dropped": dropped, "unusual": unusual, "advice": advice})
