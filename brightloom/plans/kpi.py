"""KPI tracking over orders and events."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from brightloom.functions.numeric import rounded
from brightloom.operators import kpi
from brightloom.plans.common import table
from brightloom.registry import query
from brightloom.session import measured

O = ("o_orderdate", "o_totalprice")

# DuckDB text of the long KPI table used by several queries below.
_KPIS = """d AS (SELECT CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS sales FROM orders GROUP BY 1),
 ma AS (SELECT date, CASE WHEN count(*) OVER w = 7 THEN avg(sales) OVER w END AS value FROM d
        WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
 c AS (SELECT last_day(unnest(generate_series((SELECT date_trunc('month', min(date)) FROM d),
        (SELECT date_trunc('month', max(date)) FROM d), INTERVAL 1 MONTH))) AS date),
 m AS (SELECT c.date, coalesce(s.total, 0) AS total FROM c LEFT JOIN (SELECT last_day(date) AS date, sum(sales) AS total FROM d GROUP BY 1) s
        ON s.date = c.date),
 g AS (SELECT date, (total / nullif(lag(total) OVER (ORDER BY date), 0) - 1) * 100 AS value FROM m),
 au AS (SELECT CAST(o_orderdate AS DATE) AS date, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS value FROM orders GROUP BY 1),
 rt AS (SELECT c.date, coalesce(r.value, 0) AS value FROM c LEFT JOIN (SELECT date, avg(CASE WHEN n >= 2 THEN 1.0::DOUBLE ELSE 0 END) * 100 AS value FROM (SELECT last_day(o_orderdate) AS date, o_custkey, count(*) AS n FROM orders GROUP BY ALL) GROUP BY 1) r ON r.date = c.date),
 kpis AS (SELECT * FROM (SELECT 'daily_sales' AS kpi, date, sales AS value FROM d UNION ALL SELECT 'sales_ma_7d', date, value FROM ma
        UNION ALL SELECT 'mom_growth', date, value FROM g UNION ALL SELECT 'daily_active', date, value FROM au UNION ALL SELECT 'retention_rate', date, value FROM rt) WHERE value IS NOT NULL)"""

_STATS = f"""WITH {_KPIS},
 r AS (SELECT *, row_number() OVER (PARTITION BY kpi ORDER BY date DESC) AS rank FROM kpis),
 h AS (SELECT kpi, max(value) FILTER (rank = 1) AS current, max(value) FILTER (rank = 2) AS previous,
              list(round(value, 4) ORDER BY date) FILTER (rank <= 7) AS last_values FROM r GROUP BY kpi),
 w AS (SELECT kpi, avg(value) AS mean, stddev_samp(value) AS std, count(*) AS n FROM kpis GROUP BY kpi),
 s AS (SELECT h.*, mean, std, n, (current / nullif(previous, 0) - 1) * 100 AS change_pct FROM h JOIN w ON h.kpi = w.kpi)"""


def order_kpis(spark, sf):
    return kpi.order_kpis(table(spark, sf, "orders"), *O, "o_custkey")


@query("daily_sales", "SELECT CAST(o_orderdate AS DATE) AS date, round(sum(o_totalprice), 2) AS sales FROM orders GROUP BY 1")
def daily_sales(spark, sf):
    return kpi.daily_sales(table(spark, sf, "orders"), *O).select("date", rounded("sales", 2).alias("sales"))


@query("sales_ma_7d", f"WITH {_KPIS} SELECT date, round(value, 4) AS sales_ma_7d FROM ma")
def sales_ma_7d(spark, sf):
    return kpi.sales_ma_7d(table(spark, sf, "orders"), *O).select("date", rounded("sales_ma_7d").alias("sales_ma_7d"))


@query("mom_growth", f"WITH {_KPIS} SELECT m.date AS month_end, round(total, 2) AS total, round(value, 6) AS growth FROM m JOIN g ON m.date = g.date")
def mom_growth(spark, sf):
    out = kpi.mom_growth(table(spark, sf, "orders"), *O)
    return out.select("month_end", rounded("total", 2).alias("total"), rounded("growth", 6).alias("growth"))


@query("daily_active_customers", "SELECT CAST(ts AS DATE) AS date, count(DISTINCT user_id) AS active_users FROM events GROUP BY 1")
def daily_active_customers(spark, sf):
    return kpi.daily_active(table(spark, sf, "events"), "ts", "user_id")


@query(
    "retention_rate",
    """WITH s AS (SELECT last_day(o_orderdate) AS month_end, o_custkey, count(*) AS n FROM orders GROUP BY ALL)
       SELECT month_end, round(avg(CASE WHEN n >= 2 THEN 1.0::DOUBLE ELSE 0 END) * 100, 4) AS retention_rate FROM s GROUP BY 1""",
)
def retention_rate(spark, sf):
    out = kpi.retention_rate(table(spark, sf, "orders"), "o_orderdate", "o_custkey")
    return out.select("month_end", rounded("retention_rate").alias("retention_rate"))


@query(
    "kpi_trend_stats",
    f"""{_STATS} SELECT kpi, round(current, 4) AS current, round(previous, 4) AS previous, round(change_pct, 4) AS change_pct,
        round(mean, 4) AS mean, round(std, 4) AS std, n, last_values FROM s""",
)
def kpi_trend_stats(spark, sf):
    s = kpi.kpi_trend_stats(order_kpis(spark, sf))
    return s.select(
        "kpi", *[rounded(c).alias(c) for c in ("current", "previous", "change_pct", "mean", "std")], "n",
        F.transform("last_values", lambda v: F.round(v, 4)).alias("last_values"),
    )


@query(
    "kpi_recent_30",
    f"""WITH {_KPIS} SELECT kpi, date, round(value, 4) AS value, CAST(row_number() OVER (PARTITION BY kpi ORDER BY date DESC) AS INTEGER)
        AS rank FROM kpis QUALIFY rank <= 30""",
)
def kpi_recent_30(spark, sf):
    return kpi.kpi_recent(order_kpis(spark, sf), 30).withColumn("value", rounded("value"))


@query(
    "kpi_correlations",
    f"""WITH {_KPIS}, w AS (SELECT d.date, d.sales AS a, ma.value AS b, g.value AS c FROM d LEFT JOIN ma ON ma.date = d.date
            LEFT JOIN g ON g.date = d.date)
        SELECT 'daily_sales' AS a, 'sales_ma_7d' AS b, round(corr(a, b), 6) AS r, count(b) AS n FROM w
        UNION ALL SELECT 'daily_sales', 'mom_growth', round(corr(a, c), 6), count(c) FROM w
        UNION ALL SELECT 'sales_ma_7d', 'mom_growth', round(corr(b, c), 6), count(CASE WHEN b IS NOT NULL THEN c END) FROM w""",
)
def kpi_correlations(spark, sf):
    out = kpi.kpi_correlations(order_kpis(spark, sf), ["daily_sales", "sales_ma_7d", "mom_growth"])
    return out.withColumn("r", rounded("r", 6))


# Terms of the fit whose products with the series are checked: constant, trend, one weekly and one yearly pair (0 in a shorter series).
_TERMS = {
    "constant": ("1.0::DOUBLE", lambda d, span: F.lit(1.0)),
    "trend": ("t / span", lambda d, span: d / span),
    "week_sin": ("CASE WHEN span >= 14 THEN sin(t * 2 * pi() / 7) ELSE 0 END", lambda d, span: F.when(span >= 14, F.sin(d * (2 * math.pi / 7))).otherwise(F.lit(0.0))),
    "week_cos": ("CASE WHEN span >= 14 THEN cos(t * 2 * pi() / 7) ELSE 0 END", lambda d, span: F.when(span >= 14, F.cos(d * (2 * math.pi / 7))).otherwise(F.lit(0.0))),
    "year_sin": ("CASE WHEN span >= 730.5 THEN sin(t * 2 * pi() / 365.25) ELSE 0 END", lambda d, span: F.when(span >= 730.5, F.sin(d * (2 * math.pi / 365.25))).otherwise(F.lit(0.0))),
    "year_cos": ("CASE WHEN span >= 730.5 THEN cos(t * 2 * pi() / 365.25) ELSE 0 END", lambda d, span: F.when(span >= 730.5, F.cos(d * (2 * math.pi / 365.25))).otherwise(F.lit(0.0))),
}


@query(
    "kpi_forecast",
    f"""WITH {_KPIS}, e AS (SELECT kpi, min(date) AS lo, max(date) AS hi, greatest(max(date) - min(date), 1)::DOUBLE AS span, sum(abs(value)) AS size FROM kpis GROUP BY kpi),
        r AS (SELECT kpis.kpi, value, (date - lo)::DOUBLE AS t, span, size, hi FROM kpis JOIN e ON e.kpi = kpis.kpi)
        SELECT kpi, count(*) AS n_history, CAST(30 AS BIGINT) AS n_ahead, CAST(any_value(hi) + INTERVAL 30 DAY AS DATE) AS until,
               {", ".join(f"round(sum(value * ({sql})) / any_value(size), 6) + 0.0 AS {name}" for name, (sql, _) in _TERMS.items())}, true AS bounded FROM r GROUP BY kpi""",
)
def kpi_forecast(spark, sf):
    """Normal equations per KPI: a least-squares fit has the same products with its terms as the series itself."""
    out = kpi.kpi_forecast(order_kpis(spark, sf), 30)
    past = F.col("actual").isNotNull()
    ends = out.filter(past).groupBy("kpi").agg(F.min("date").alias("lo"), F.greatest(F.date_diff(F.max("date"), F.min("date")), F.lit(1)).cast("double").alias("span"), F.sum(F.abs("actual")).alias("size"))
    rows = out.join(measured(ends), "kpi").withColumn("t", F.date_diff("date", "lo").cast("double"))
    products = [
        (rounded(F.sum(F.when(past, F.col("forecast") * term(F.col("t"), F.col("span")))) / F.max("size"), 6) + F.lit(0.0)).alias(name) for name, (_, term) in _TERMS.items()
    ]
    return rows.groupBy("kpi").agg(
        F.count_if(past).alias("n_history"), F.count_if(~past).alias("n_ahead"), F.max("date").alias("until"), *products,
        F.every((F.col("lower") <= F.col("forecast")) & (F.col("forecast") <= F.col("upper"))).alias("bounded"),
    )


@query(
    "kpi_rules",
    f"""{_STATS} SELECT kpi, coalesce(change_pct < -10, false) AS dropped, coalesce(abs(current - mean) > 2 * std, false) AS unusual,
        CASE WHEN dropped AND unusual THEN 'investigate now' WHEN dropped THEN 'watch drop' WHEN unusual THEN 'check level' ELSE 'ok' END
        AS advice FROM s""",
)
def kpi_rules(spark, sf):
    out = kpi.kpi_rules(kpi.kpi_trend_stats(order_kpis(spark, sf)))
    return out.select("kpi", "dropped", "unusual", "advice")
