"""Anomaly detection over orders with spikes, events and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.functions.numeric import rounded
from brightloom.operators import anomaly, autoencoder, eda
from brightloom.operators import timeseries as ts
from brightloom.plans.common import spiked, table
from brightloom.registry import query

_S = """s AS (SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey % 997 = 0 THEN o_totalprice * 10 ELSE o_totalprice END AS x FROM orders),
 z AS (SELECT avg(x) AS m, stddev_pop(x) AS sd, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM s),
 f AS (SELECT o_orderkey, o_orderdate, x, abs((x - m) / sd) > 3 AS z_anomaly, x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1) AS iqr_anomaly FROM s, z)"""


def spiked_orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate", spiked().alias("x"))


def flagged_orders(spark, sf):
    return anomaly.iqr_flag(anomaly.zscore_flag(spiked_orders(spark, sf), "x"), "x")


@query(
    "zscore_scale",
    """WITH z AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s, avg(l_extendedprice) AS pm, stddev_pop(l_extendedprice) AS ps FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - m) / s, 6) + 0::DOUBLE AS l_quantity_z, round((l_extendedprice - pm) / ps, 6) + 0::DOUBLE AS l_extendedprice_z
       FROM lineitem, z""",
)
def zscore_scale(spark, sf):
    out = anomaly.zscore_scale(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", *[rounded(c, 6).alias(c) for c in ("l_quantity_z", "l_extendedprice_z")]
    )


@query("zscore_anomalies", f"WITH {_S} SELECT o_orderkey, o_orderdate, x FROM f WHERE z_anomaly")
def zscore_anomalies(spark, sf):
    return anomaly.zscore_flag(spiked_orders(spark, sf), "x").filter("z_anomaly").drop("z_anomaly")


@query("iqr_outliers", f"WITH {_S} SELECT o_orderkey, o_orderdate, x FROM f WHERE iqr_anomaly")
def iqr_outliers(spark, sf):
    return anomaly.iqr_flag(spiked_orders(spark, sf), "x").filter("iqr_anomaly").drop("iqr_anomaly")


@query("isolation_forest")
def isolation_forest(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "value")
    return anomaly.isolation_forest(e, ["value"], "event_id").filter("if_anomaly").withColumn("if_score", rounded("if_score", 6))


@query("reconstruction_error")
def reconstruction_error(spark, sf):
    d = ts.daily(table(spark, sf, "orders"), "o_orderdate", [F.sum("o_totalprice").alias("sales")])
    daily = anomaly.reconstruction_error(anomaly.lag_vectors(d, "date", "sales", 7), "window_values", 3)
    daily = daily.filter("recon_anomaly").select(
        F.lit("daily_sales").alias("source"), F.col("date").cast("string").alias("item"), rounded("recon_error").alias("recon_error")
    )
    e = anomaly.reconstruction_error(table(spark, sf, "embeddings"), "embedding", 8).filter("recon_anomaly")
    return daily.unionByName(
        e.select(F.lit("embeddings").alias("source"), F.col("vec_id").cast("string").alias("item"), rounded("recon_error").alias("recon_error"))
    )


@query(
    "anomaly_ensemble",
    f"""WITH {_S} SELECT o_orderkey, x, CASE WHEN z_anomaly AND iqr_anomaly THEN 'zscore,iqr' WHEN z_anomaly THEN 'zscore' WHEN iqr_anomaly THEN 'iqr'
        ELSE '' END AS methods, z_anomaly OR iqr_anomaly AS is_anomaly FROM f""",
)
def anomaly_ensemble(spark, sf):
    out = anomaly.anomaly_ensemble(flagged_orders(spark, sf), {"zscore": F.col("z_anomaly"), "iqr": F.col("iqr_anomaly")})
    return out.select("o_orderkey", "x", F.array_join("methods", ",").alias("methods"), "is_anomaly")


@query(
    "anomaly_summary",
    f"""WITH {_S} SELECT count(*) AS n_rows, count(*) FILTER (z_anomaly) AS n_z_anomaly, count(*) FILTER (iqr_anomaly) AS n_iqr_anomaly,
        count(*) FILTER (z_anomaly OR iqr_anomaly) AS n_any, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts, round(min(x), 4) AS lowest,
        round(max(x), 4) AS highest FROM f""",
)
def anomaly_summary(spark, sf):
    out = anomaly.anomaly_summary(flagged_orders(spark, sf), ["z_anomaly", "iqr_anomaly"], "o_orderdate", "x")
    return out.withColumns({"lowest": rounded("lowest"), "highest": rounded("highest")})


@query(
    "anomaly_report_context",
    f"""WITH {_S} SELECT 'size' AS section, 'n_rows' AS item, CAST(count(*) AS VARCHAR) AS value FROM f
        UNION ALL SELECT 'time', 'first', CAST(min(o_orderdate) AS VARCHAR) FROM f UNION ALL SELECT 'time', 'last', CAST(max(o_orderdate) AS VARCHAR) FROM f
        UNION ALL SELECT 'method', 'zscore', CAST(count(*) FILTER (z_anomaly) AS VARCHAR) FROM f UNION ALL SELECT 'method', 'iqr', CAST(count(*) FILTER (iqr_anomaly) AS VARCHAR) FROM f
        UNION ALL SELECT 'method', 'any', CAST(count(*) FILTER (z_anomaly OR iqr_anomaly) AS VARCHAR) FROM f""",
)
def anomaly_report_context(spark, sf):
    """Sizes, time range and flagged rows per method of a table with anomalies."""
    z, q = F.col("z_anomaly"), F.col("iqr_anomaly")
    out = eda.report_context(flagged_orders(spark, sf), "o_orderdate", {"zscore": z, "iqr": q, "any": z | q})
    return out.filter("section IN ('time', 'method') OR item = 'n_rows'")


@query(
    "autoencoder_error",
    """WITH n AS (SELECT count(DISTINCT CAST(o_orderdate AS DATE)) - 6 AS n FROM orders)
       SELECT n AS n_rows, n - 1 - CAST(floor(0.95::DOUBLE * (n - 1)) AS BIGINT) AS n_anomalies, true AS all_scored, true AS flagged_are_worst FROM n""",
)
def autoencoder_error(spark, sf):
    """Checked summary of the network's reconstruction of weeks of daily sales: the worst twentieth is flagged."""
    d = ts.daily(table(spark, sf, "orders"), "o_orderdate", [F.sum("o_totalprice").alias("sales")])
    out = autoencoder.autoencoder_error(anomaly.lag_vectors(d, "date", "sales", 7), "window_values")
    worst = F.min(F.when(F.col("recon_anomaly"), F.col("recon_error"))) > F.max(F.when(~F.col("recon_anomaly"), F.col("recon_error")))
    return out.agg(F.count("*").alias("n_rows"), F.count_if("recon_anomaly").alias("n_anomalies"), F.every(F.col("recon_error") >= 0).alias("all_scored"), worst.alias("flagged_are_worst"))
