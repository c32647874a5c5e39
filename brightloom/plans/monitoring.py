"""Pipeline monitoring over events: value stands for latency, type 'error' for a failed record."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.functions.numeric import rounded
from brightloom.operators.relational import tail_recent
from brightloom.plans.common import table
from brightloom.registry import query
from brightloom.session import fresh_path
from brightloom.streaming import monitor as mon

LIMITS = {"latency_ms": (55.0, "above"), "error_rate": (0.1, "above"), "data_quality_score": (0.6, "below")}

_W = """w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n, avg(value) AS latency_ms,
  avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0 END) AS error_rate, avg(CASE WHEN value > 10 THEN 1.0::DOUBLE ELSE 0 END) AS data_quality_score
  FROM events GROUP BY 1)"""
_T = """t AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, avg(value) AS mean FROM events GROUP BY ALL)"""


def events_stream(spark, sf):
    return mon.read_stream(spark, sf, table(spark, sf, "events").schema, "events.parquet")


def health(spark, sf):
    return mon.health_metrics(table(spark, sf, "events"), "ts", "value", F.col("event_type") == "error", F.col("value") > 10)


def hourly(df):
    return mon.window_metrics(df, "ts", "value", ["event_type"], "1 hour")


@query(
    "stream_window_metrics",
    """SELECT * FROM (SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS window_start, time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES AS window_end,
         event_type, count(*) AS n, round(avg(value), 8) AS mean, round(stddev_samp(value), 6) AS std FROM events GROUP BY ALL)
       WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTES FROM events)""",
)
def stream_window_metrics(spark, sf):
    """Windows closed by the watermark, appended by a streaming query and read back."""
    path = fresh_path(spark, "metrics")
    m = mon.window_metrics(events_stream(spark, sf), "ts", "value", ["event_type"], "5 minutes", "10 minutes")
    mon.append_to_table(m, path).awaitTermination()
    return spark.read.parquet(path).withColumns({"mean": rounded("mean", 8), "std": rounded("std", 6)})


@query(
    "batch_window_metrics",
    """SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS window_start, time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES AS window_end,
       event_type, count(*) AS n, round(avg(value), 8) AS mean, round(stddev_samp(value), 6) AS std FROM events GROUP BY ALL""",
)
def batch_window_metrics(spark, sf):
    m = mon.window_metrics(table(spark, sf, "events"), "ts", "value", ["event_type"], "5 minutes")
    return m.withColumns({"mean": rounded("mean", 8), "std": rounded("std", 6)})


def _num(c):
    parts = (("mean", f"avg({c})"), ("std", f"stddev_samp({c})"), ("min", f"min({c})"), ("max", f"max({c})"))
    return " UNION ALL ".join(f"SELECT '{c}', '{m}', NULL, {e} FROM e" for m, e in parts)


def _text(c):
    return f"""SELECT '{c}', 'unique_count', NULL, count(DISTINCT {c}) FROM e
      UNION ALL (SELECT '{c}', 'top_value', {c}, count(*) FROM e GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 5)"""


@query(
    "stream_quality_checks",
    f"""WITH e AS (SELECT * FROM events),
        a AS (SELECT '*' AS "column", 'row_count' AS metric, NULL AS item, CAST(count(*) AS DOUBLE) AS value FROM e
          UNION ALL SELECT '*', 'duplicate_rows', NULL, (SELECT count(*) FROM e) - (SELECT count(*) FROM (SELECT DISTINCT * FROM e))
          UNION ALL {" UNION ALL ".join(f"SELECT '{c}', 'null_count', NULL, count(*) - count({c}) FROM e" for c in ("event_id", "ts", "user_id", "event_type", "value", "props"))}
          UNION ALL {_num("event_id")} UNION ALL {_num("user_id")} UNION ALL {_num("value")} UNION ALL {" UNION ALL ".join(_text(c) for c in ("event_type", "props"))})
       SELECT 0 AS batch_id, "column", metric, CAST(item AS VARCHAR) AS item, round(value, 4) AS value FROM a""",
)
def stream_quality_checks(spark, sf):
    path = fresh_path(spark, "quality")
    mon.stream_quality_checks(events_stream(spark, sf), path).awaitTermination()
    return spark.read.parquet(path).withColumn("value", rounded("value"))


def _alert(metric, cond, ratio, limit):
    return f"""SELECT window_start, n, '{metric}' AS metric, round({metric}, 6) AS value, {limit}::DOUBLE AS "limit",
      CASE WHEN {ratio} >= 2 THEN 'critical' WHEN {ratio} >= 1.5 THEN 'high' ELSE 'medium' END AS severity FROM w WHERE {cond}"""


_ALERTS = " UNION ALL ".join(
    [
        _alert("latency_ms", "latency_ms > 55", "latency_ms / 55", 55), _alert("error_rate", "error_rate > 0.1", "error_rate / 0.1", 0.1),
        _alert("data_quality_score", "data_quality_score < 0.6", "0.6 / greatest(data_quality_score, 1e-9)", 0.6),
    ]
)


@query("threshold_alerts", f"WITH {_W} {_ALERTS}")
def threshold_alerts(spark, sf):
    return mon.threshold_alerts(health(spark, sf), LIMITS).withColumn("value", rounded("value", 6))


@query(
    "history_deviation",
    f"""WITH {_T} SELECT event_type, window_start, round(mean, 8) AS mean, round((mean - avg(mean) OVER h) / nullif(stddev_samp(mean) OVER h, 0), 4) + 0::DOUBLE AS z FROM t
        WINDOW h AS (PARTITION BY event_type ORDER BY window_start ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)""",
)
def history_deviation(spark, sf):
    out = mon.history_deviation(hourly(table(spark, sf, "events")), "window_start", "mean", ["event_type"], 24)
    return out.select("event_type", "window_start", rounded("mean", 8).alias("mean"), rounded("z").alias("z"))


@query(
    "history_deviation_stream",
    f"""WITH {_T} SELECT event_type, window_start, round(mean, 8) AS mean, round((mean - avg(mean) OVER h) / nullif(stddev_samp(mean) OVER h, 0), 4) + 0::DOUBLE AS z FROM t
        WINDOW h AS (PARTITION BY event_type ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        QUALIFY window_start < (SELECT max(window_start) - INTERVAL 2 HOUR FROM t)""",
)
def history_deviation_stream(spark, sf):
    """Hourly metrics written as files in no order, then read as a stream; rows that the watermark has passed."""
    source, path = fresh_path(spark, "metrics"), fresh_path(spark, "deviation")
    m = hourly(table(spark, sf, "events")).select("event_type", "window_start", "mean")
    m.write.parquet(source)
    z = mon.history_deviation_stream(mon.read_stream(spark, source, m.schema), "window_start", "mean", "event_type")
    mon.append_to_table(z, path).awaitTermination()
    out = spark.read.parquet(path)
    return out.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), rounded("mean", 8).alias("mean"), rounded("z").alias("z"))


@query(
    "alert_sink",
    f"""WITH {_W}, a AS ({_ALERTS}) SELECT window_start, metric, value, severity FROM a ORDER BY window_start DESC, metric DESC LIMIT 5""",
)
def alert_sink(spark, sf):
    source, path = fresh_path(spark, "health"), fresh_path(spark, "alerts")
    h = health(spark, sf)
    h.write.parquet(source)
    mon.alert_sink(mon.read_stream(spark, source, h.schema), path, LIMITS).awaitTermination()
    last = tail_recent(spark.read.parquet(path), "window_start", "metric", 5)
    return last.select("window_start", "metric", rounded("value", 6).alias("value"), "severity")


@query("metrics_retention", "SELECT event_id, ts, value FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOURS")
def metrics_retention(spark, sf):
    return mon.metrics_retention(table(spark, sf, "events").select("event_id", "ts", "value"), "ts", 24)


@query(
    "monitor_timeline",
    f"""WITH {_W}, u AS (SELECT window_start, CAST(n AS DOUBLE) AS n, latency_ms, error_rate FROM w)
        SELECT window_start, metric, round(value, 6) AS value FROM (UNPIVOT u ON n, latency_ms, error_rate INTO NAME metric VALUE value) ORDER BY 1, 2""",
)
def monitor_timeline(spark, sf):
    out = mon.monitor_timeline(health(spark, sf).drop("data_quality_score"), "window_start", ["n", "latency_ms", "error_rate"])
    return out.withColumn("value", rounded("value", 6))


@query("latest_snapshot", f"WITH {_T} SELECT event_type, max(window_start) AS window_start, max_by(n, window_start) AS n, round(max_by(mean, window_start), 8) AS mean FROM t GROUP BY event_type")
def latest_snapshot(spark, sf):
    out = mon.latest_snapshot(hourly(table(spark, sf, "events")).select("event_type", "window_start", "n", "mean"), "window_start", ["event_type"])
    return out.withColumn("mean", rounded("mean", 8))
