"""Window functions and time series."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.functions.numeric import rounded
from brightloom.operators import timeseries as ts
from brightloom.operators.ranking import value_ranges
from brightloom.plans.common import table
from brightloom.registry import query


@query(
    "running_total",
    """SELECT date, round(sales, 2) AS sales, round(sum(sales) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING), 2) AS running_total
       FROM (SELECT CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS sales FROM orders GROUP BY 1)""",
)
def running_total(spark, sf):
    d = ts.daily(table(spark, sf, "orders"), "o_orderdate", [F.sum("o_totalprice").alias("sales")])
    out = ts.running_total(d, "date", "sales")
    return out.select("date", rounded("sales", 2).alias("sales"), rounded("running_total", 2).alias("running_total"))


@query(
    "rolling_mean_std",
    """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS date, sum(value) AS total FROM events GROUP BY ALL)
       SELECT event_type, date, CASE WHEN count(*) OVER w = 7 THEN round(avg(total) OVER w, 4) END AS rolling_mean,
              CASE WHEN count(*) OVER w = 7 THEN round(stddev_samp(total) OVER w, 4) END AS rolling_std FROM d
       WINDOW w AS (PARTITION BY event_type ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def rolling_mean_std(spark, sf):
    d = ts.daily(table(spark, sf, "events"), "ts", [F.sum("value").alias("total")], ["event_type"])
    out = ts.rolling_mean_std(d, "date", "total", ["event_type"])
    return out.select(
        "event_type", "date", rounded("rolling_mean").alias("rolling_mean"), rounded("rolling_std").alias("rolling_std")
    )


@query(
    "resample_month",
    """WITH o AS (SELECT * FROM orders WHERE NOT (year(o_orderdate) = 1997 AND month(o_orderdate) = 3)),
            m AS (SELECT last_day(o_orderdate) AS month_end, sum(o_totalprice) AS total, avg(o_totalprice) AS mean, count(*) AS n
                  FROM o GROUP BY 1),
            c AS (SELECT last_day(unnest(generate_series((SELECT date_trunc('month', min(o_orderdate)) FROM o),
                  (SELECT date_trunc('month', max(o_orderdate)) FROM o), INTERVAL 1 MONTH))) AS month_end)
       SELECT c.month_end, round(coalesce(total, 0), 2) AS total, round(mean, 4) AS mean, coalesce(n, 0) AS n
       FROM c LEFT JOIN m ON c.month_end = m.month_end""",
)
def resample_month(spark, sf):
    gap = (F.year("o_orderdate") == 1997) & (F.month("o_orderdate") == 3)
    out = ts.resample_month(table(spark, sf, "orders").filter(~gap), "o_orderdate", "o_totalprice")
    return out.select("month_end", rounded("total", 2).alias("total"), rounded("mean").alias("mean"), "n")


@query(
    "pct_change",
    """WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, sum(o_totalprice) AS revenue FROM orders GROUP BY 1)
       SELECT month, round(revenue, 2) AS revenue, round((revenue / lag(revenue) OVER (ORDER BY month) - 1) * 100, 6) AS pct_change FROM m""",
)
def pct_change(spark, sf):
    m = table(spark, sf, "orders").groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(F.sum("o_totalprice").alias("revenue"))
    out = ts.pct_change(m, "month", "revenue")
    return out.select("month", rounded("revenue", 2).alias("revenue"), rounded("pct_change", 6).alias("pct_change"))


@query(
    "context_window",
    """WITH p AS (SELECT event_type, event_id, ts, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS pos FROM events)
       SELECT a.event_type, a.event_id AS anomaly_id, CAST(b.pos - a.pos AS INTEGER) AS "offset", b.event_id, b.ts, b.value
       FROM p a JOIN p b ON a.event_type = b.event_type AND b.pos >= a.pos - 10 AND b.pos < a.pos + 10 WHERE a.value > 150""",
)
def context_window(spark, sf):
    e = value_ranges(table(spark, sf, "events").select("event_type", "event_id", "ts", "value"), "ts", tie="event_id")
    return ts.context_window(e, F.col("value") > 150, ["ts", "event_id"], F.col("__range"), "event_id", ["event_type"]).drop("__range")


@query(
    "seasonal_decompose",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS sales FROM orders GROUP BY 1),
            i AS (SELECT *, row_number() OVER (ORDER BY date) - 1 AS i FROM d),
            t AS (SELECT date, sales, i, CASE WHEN count(*) OVER w = 31 THEN
                    (sum(sales) OVER w - (lag(sales, 15) OVER (ORDER BY date) + lead(sales, 15) OVER (ORDER BY date)) / 2) / 30 END AS trend
                  FROM i WINDOW w AS (ORDER BY date ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING)),
            m AS (SELECT i % 30 AS phase, avg(sales - trend) AS m FROM t GROUP BY 1),
            s AS (SELECT phase, m - (SELECT avg(m) FROM m) AS seasonal FROM m)
       SELECT date, round(sales, 2) AS sales, round(trend, 4) AS trend, round(seasonal, 4) AS seasonal,
              round(sales - trend - seasonal, 4) AS residual FROM t JOIN s ON s.phase = t.i % 30""",
)
def seasonal_decompose(spark, sf):
    d = ts.daily(table(spark, sf, "orders"), "o_orderdate", [F.sum("o_totalprice").alias("sales")])
    out = ts.seasonal_decompose(d, "date", "sales", 30)
    return out.select("date", rounded("sales", 2).alias("sales"), *[rounded(c).alias(c) for c in ("trend", "seasonal", "residual")])
