"""Pipeline monitoring. Every transformation takes a batch or a streaming DataFrame; the runners below start
Structured Streaming queries with checkpoints in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from brightloom.operators.quality import data_quality_metrics
from brightloom.session import fresh_path

# Default limits of the monitor.
THRESHOLDS = {"latency_ms": (1000.0, "above"), "error_rate": (0.01, "above"), "data_quality_score": (0.95, "below")}


def window_metrics(df: DataFrame, ts: str, value: str, by: list[str], width: str = "5 minutes", watermark: str | None = None) -> DataFrame:
    """Per tumbling window and group: count, mean, sample std. With ``watermark``, rows older than it are dropped
    and a stream keeps state only for windows still open."""
    if watermark:
        df = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    out = df.groupBy(F.window(ts, width).alias("w"), *by).agg(
        F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")
    )
    return out.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"), *by, "n", "mean", "std"
    )


def health_metrics(df: DataFrame, ts: str, latency: str, is_error: Column, ok_value: Column, width: str = "1 hour") -> DataFrame:
    """Per window: rows, mean latency, error rate and share of valid rows."""
    out = df.groupBy(F.window(ts, width).alias("w")).agg(
        F.count("*").alias("n"), F.avg(latency).alias("latency_ms"), F.avg(is_error.cast("double")).alias("error_rate"),
        F.avg(ok_value.cast("double")).alias("data_quality_score"),
    )
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n", "latency_ms", "error_rate", "data_quality_score")


def threshold_alerts(metrics: DataFrame, thresholds: Mapping[str, tuple[float, str]] = THRESHOLDS) -> DataFrame:
    """Rows × metrics beyond their limit: the other columns plus ``metric, value, limit, severity``. Stateless.

    Severity grows with the distance from the limit: medium, high from 1.5 times, critical from 2 times.
    """
    names = [m for m in thresholds if m in metrics.columns]
    checks = []
    for m in names:
        limit, side = thresholds[m]
        x = F.col(m).cast("double")
        beyond, ratio = (x > limit, x / limit) if side == "above" else (x < limit, limit / F.greatest(x, F.lit(1e-9)))
        severity = F.when(ratio >= 2, "critical").when(ratio >= 1.5, "high").otherwise("medium")
        checks.append(
            F.when(beyond, F.struct(F.lit(m).alias("metric"), x.alias("value"), F.lit(float(limit)).alias("limit"), severity.alias("severity")))
        )
    rest = [c for c in metrics.columns if c not in names]
    hits = F.filter(F.array(*checks), lambda a: a.isNotNull())
    return metrics.select(*rest, F.inline(hits))


def history_deviation(metrics: DataFrame, order: str, value: str, by: list[str], n: int | None = 24) -> DataFrame:
    """Add ``z``: distance of the value from the mean of the previous ``n`` windows (all with ``None``) in their
    sample stds. Input is one row per window and group."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-n if n else Window.unboundedPreceding, -1)
    mean, std = F.avg(value).over(w), F.stddev_samp(value).over(w)
    return metrics.withColumn("z", F.when(std > 0, (F.col(value) - mean) / std))


def _running_z(x: np.ndarray, n: int, mean: float, m2: float) -> tuple[np.ndarray, int, float, float]:
    """Distance of every value from the mean of all before it in their sample stds, and the moments after the last."""
    y = x - mean
    before = n + np.arange(len(x))
    s1, s2 = np.r_[0.0, np.cumsum(y)], np.r_[0.0, np.cumsum(y * y)]
    with np.errstate(divide="ignore", invalid="ignore"):
        shift = np.where(before > 0, s1[:-1] / before, 0.0)
        spread = m2 + s2[:-1] - s1[:-1] * shift
        std = np.sqrt(np.maximum(spread, 0) / (before - 1))
        z = np.where((before > 1) & (std > 0), (y - shift) / std, np.nan)
    total = n + len(x)
    return z, total, mean + s1[-1] / max(total, 1), m2 + s2[-1] - s1[-1] ** 2 / max(total, 1)


def history_deviation_stream(metrics: DataFrame, order: str, value: str, by: str, delay: str = "2 hours", idle: str = "30 days") -> DataFrame:
    """Streaming twin over all earlier windows, in event-time order whatever order the rows arrive in.

    A row is emitted once the watermark (``delay`` behind the newest row) has passed it; until then the state holds it.
    Besides, the state of a group is three running moments, and it is dropped after ``idle`` without rows.
    """
    kept_ms = int(pd.Timedelta(idle).total_seconds() * 1000)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, mean, m2, times, values = state.get if state.exists else (0, 0.0, 0.0, [], [])
        mark = state.getCurrentWatermarkMs()
        parts = [(np.asarray(times, np.int64), np.asarray(values, float))]
        if not state.hasTimedOut:
            parts += [(b["__ms"].to_numpy(np.int64), b[value].to_numpy(float)) for b in batches]
        t, x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        o = np.argsort(t, kind="stable")
        t, x = t[o], x[o]
        ready = int(np.searchsorted(t, mark))
        z, n, mean, m2 = _running_z(x[:ready], n, mean, m2)
        if ready == len(t) and state.hasTimedOut and not ready:
            state.remove()
            return
        state.update((n, mean, m2, t[ready:].tolist(), x[ready:].tolist()))
        state.setTimeoutTimestamp(max(mark + 1, int(t[ready]) if ready < len(t) else max(mark, 0) + kept_ms))
        if ready:
            yield pd.DataFrame({by: [key[0]] * ready, order: pd.to_datetime(t[:ready], unit="ms"), value: x[:ready], "z": z})

    d = metrics.select(by, F.col(order).cast("timestamp").alias(order), F.col(value).cast("double").alias(value)).withWatermark(order, delay)
    d = d.withColumn("__ms", F.unix_millis(order))
    kind = d.schema[by].dataType.simpleString()
    state_type = "n long, mean double, m2 double, times array<long>, vals array<double>"
    out = d.groupBy(by).applyInPandasWithState(
        step, f"{by} {kind}, {order} timestamp, {value} double, z double", state_type, "append", GroupStateTimeout.EventTimeTimeout
    )
    return out.withColumn("z", F.when(~F.isnan("z"), F.col("z")))


def metrics_retention(df: DataFrame, ts: str, hours: int = 24) -> DataFrame:
    """Rows strictly newer than ``hours`` before the newest one."""
    latest = df.agg(F.max(ts)).scalar()
    return df.filter(F.col(ts) > latest - F.expr(f"INTERVAL {int(hours)} HOURS"))


def monitor_timeline(metrics: DataFrame, order: str, names: list[str]) -> DataFrame:
    """Long ``(order, metric, value)`` for plotting, ordered in time."""
    ids = [c for c in metrics.columns if c not in names]
    wide = metrics.select(*ids, *[F.col(c).cast("double").alias(c) for c in names])
    return wide.unpivot(ids, names, "metric", "value").orderBy(order, "metric")


def latest_snapshot(metrics: DataFrame, order: str, by: list[str]) -> DataFrame:
    """The most recent row per key, as an aggregate."""
    rest = [c for c in metrics.columns if c not in by]
    return metrics.groupBy(*by).agg(F.max_by(F.struct(*rest), F.col(order)).alias("m")).select(*by, "m.*")


def read_stream(spark: SparkSession, folder: str, schema, glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files appearing in ``folder`` as a stream."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(folder)


def _checkpoint(spark: SparkSession, checkpoint: str | None) -> str:
    return checkpoint or fresh_path(spark, "checkpoint")


def append_to_table(stream: DataFrame, path: str, checkpoint: str | None = None, every: str | None = None) -> StreamingQuery:
    """Exactly-once parquet append. Without ``every`` the query handles all available files and stops."""
    w = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", _checkpoint(stream.sparkSession, checkpoint))
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start(path)


def per_batch_table(
    stream: DataFrame, path: str, transform: Callable[[DataFrame], DataFrame], checkpoint: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Write ``transform(batch)`` below ``path/batch_id=<n>``; a replayed batch replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # a transformation may read it several times
        try:
            transform(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", _checkpoint(stream.sparkSession, checkpoint))
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def stream_quality_checks(stream: DataFrame, path: str, **kwargs) -> StreamingQuery:
    """Quality metrics of every micro-batch as a table partitioned by batch."""
    return per_batch_table(stream, path, data_quality_metrics, **kwargs)


def alert_sink(stream: DataFrame, path: str, thresholds: Mapping[str, tuple[float, str]] = THRESHOLDS, **kwargs) -> StreamingQuery:
    """Alerts of every micro-batch of metric rows, stamped with the time they were raised."""
    return per_batch_table(stream, path, lambda b: threshold_alerts(b, thresholds).withColumn("raised_at", F.current_timestamp()), **kwargs)
