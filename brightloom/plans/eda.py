"""Exploratory analysis and chart-ready tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from brightloom.functions.numeric import rounded
from brightloom.operators import eda, profile
from brightloom.plans.common import spiked, table
from brightloom.registry import query

L4 = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "distribution_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(avg({c}), 4) AS mean, round(median({c}), 4) AS median, round(skewness({c}), 6) AS skew,
            round(kurtosis({c}), 6) AS kurtosis, round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.75), 4) AS q3 FROM lineitem"""
        for c in L4
    ),
)
def distribution_stats(spark, sf):
    out = profile.distribution_stats(table(spark, sf, "lineitem"), list(L4))
    return out.select(
        "column", *[rounded(c).alias(c) for c in ("mean", "median", "q1", "q3")], *[rounded(c, 6).alias(c) for c in ("skew", "kurtosis")]
    )


@query(
    "histogram_bins",
    """WITH s AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 20 AS w FROM orders),
            b AS (SELECT CAST(least(floor((o_totalprice - lo) / w), 19) AS INTEGER) AS bin, count(*) AS n FROM orders, s GROUP BY 1)
       SELECT CAST(i AS INTEGER) AS bin, round(lo + i * w, 4) AS lo, round(lo + i * w + w, 4) AS hi, coalesce(n, 0) AS n
       FROM s, range(20) r(i) LEFT JOIN b ON b.bin = i""",
)
def histogram_bins(spark, sf):
    out = eda.histogram_bins(table(spark, sf, "orders"), "o_totalprice", 20)
    return out.select("bin", rounded("lo").alias("lo"), rounded("hi").alias("hi"), "n")


@query("grouped_histogram", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def grouped_histogram(spark, sf):
    return eda.grouped_histogram(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query(
    "box_plot_stats",
    """WITH q AS (SELECT o_orderstatus, count(*) AS n, min(o_totalprice) AS lowest, quantile_cont(o_totalprice, 0.25) AS q1,
           median(o_totalprice) AS median, quantile_cont(o_totalprice, 0.75) AS q3, max(o_totalprice) AS highest FROM
           (SELECT o_orderstatus, CASE WHEN o_orderkey % 997 = 0 THEN o_totalprice * 10 ELSE o_totalprice END AS o_totalprice FROM orders)
           GROUP BY 1),
        o AS (SELECT q.o_orderstatus, count(*) AS k FROM orders JOIN q ON q.o_orderstatus = orders.o_orderstatus
              WHERE (CASE WHEN o_orderkey % 997 = 0 THEN o_totalprice * 10 ELSE o_totalprice END) NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY 1)
       SELECT q.o_orderstatus, n, round(lowest, 6) AS lowest, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
              round(highest, 6) AS highest, round(q1 - 1.5 * (q3 - q1), 6) AS lower_fence, round(q3 + 1.5 * (q3 - q1), 6) AS upper_fence,
              coalesce(k, 0) AS n_outliers FROM q LEFT JOIN o ON o.o_orderstatus = q.o_orderstatus""",
)
def box_plot_stats(spark, sf):
    o = table(spark, sf, "orders").select("o_orderstatus", spiked().alias("o_totalprice"))
    out = eda.box_plot_stats(o, "o_orderstatus", "o_totalprice")
    cols = ("lowest", "q1", "median", "q3", "highest", "lower_fence", "upper_fence")
    return out.select("o_orderstatus", "n", *[rounded(c, 6).alias(c) for c in cols], "n_outliers")


@query(
    "bar_line_scatter_data",
    """SELECT 'bar' AS series, o_orderpriority AS x, round(sum(o_totalprice), 2) AS y FROM orders GROUP BY o_orderpriority
       UNION ALL SELECT 'line', CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR), round(sum(o_totalprice), 2) FROM orders GROUP BY 2
       UNION ALL SELECT 'scatter', CAST(o_orderkey AS VARCHAR), o_totalprice FROM orders WHERE starts_with(md5(CAST(o_orderkey AS VARCHAR)), '0')""",
)
def bar_line_scatter_data(spark, sf):
    o = table(spark, sf, "orders")
    bar = eda.xy_sum(o, F.col("o_orderpriority"), "o_totalprice")
    line = eda.xy_sum(o, F.trunc("o_orderdate", "month").cast("string"), "o_totalprice")
    dots = eda.hash_sample(o, "o_orderkey").select(F.col("o_orderkey").cast("string").alias("x"), F.col("o_totalprice").alias("y"))
    out = bar.withColumn("series", F.lit("bar")).unionByName(line.withColumn("series", F.lit("line")))
    out = out.withColumn("y", rounded("y", 2)).unionByName(dots.withColumn("series", F.lit("scatter")))
    return out.select("series", "x", "y")


def _corr_rows(cols, t, where=""):
    rows = [f"SELECT '{c}' AS a, '{c}' AS b, 1.0::DOUBLE AS r" for c in cols]
    for a, b in combinations(cols, 2):
        rows += [f"SELECT '{x}', '{y}', round(corr({a}, {b}), 6) FROM {t}" for x, y in ((a, b), (b, a))]
    return " UNION ALL ".join(rows)


@query("correlation_matrix", _corr_rows(L4, "lineitem"))
def correlation_matrix(spark, sf):
    return eda.correlation_matrix(table(spark, sf, "lineitem"), L4).withColumn("r", rounded("r", 6))


@query(
    "strong_correlations",
    " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM
            (SELECT *, l_extendedprice * (1 - l_discount) AS net FROM lineitem)) WHERE abs(r) > 0.5"""
        for a, b in combinations(("l_quantity", "l_extendedprice", "l_discount", "net"), 2)
    ),
)
def strong_correlations(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return eda.strong_correlations(li, ["l_quantity", "l_extendedprice", "l_discount", "net"]).withColumn("r", rounded("r", 6))


@query(
    "categorical_numeric_relations",
    " UNION ALL ".join(
        f"""SELECT '{k}' AS category, {k} AS level, '{c}' AS "column", count(*) AS n, round(avg({c}), 4) AS mean, round(median({c}), 4) AS median
            FROM lineitem GROUP BY {k}"""
        for k in ("l_returnflag", "l_linestatus") for c in ("l_quantity", "l_extendedprice", "l_tax")
    ),
)
def categorical_numeric_relations(spark, sf):
    out = eda.categorical_numeric_relations(
        table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice", "l_tax"]
    )
    return out.select("category", "level", "column", "n", rounded("mean").alias("mean"), rounded("median").alias("median"))


_NUM = ("c_custkey", "c_nationkey", "c_acctbal")
_STR = ("c_name", "c_mktsegment")
_ALL = (*_NUM, *_STR)


@query(
    "data_profile",
    " UNION ALL ".join(
        [
            f"""SELECT 'describe' AS section, '{c}' AS "column", '{i}' AS item, round({e}, 4) AS value FROM customer"""
            for c in _NUM
            for i, e in (
                ("n", f"CAST(count({c}) AS DOUBLE)"), ("mean", f"avg({c})"), ("std", f"stddev_samp({c})"), ("lowest", f"CAST(min({c}) AS DOUBLE)"),
                ("q1", f"quantile_cont({c}, 0.25)"), ("median", f"quantile_cont({c}, 0.5)"), ("q3", f"quantile_cont({c}, 0.75)"),
                ("highest", f"CAST(max({c}) AS DOUBLE)"),
            )
        ]
        + [f"SELECT 'missing', '{c}', NULL, CAST(count(*) - count({c}) AS DOUBLE) FROM customer" for c in _ALL]
        + [f"SELECT 'distinct', '{c}', NULL, CAST(count(DISTINCT {c}) AS DOUBLE) FROM customer" for c in _ALL]
        + [f"(SELECT 'top', '{c}', {c}, CAST(count(*) AS DOUBLE) FROM customer GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 5)" for c in _STR]
        + ["SELECT 'correlation', a, b, round(r, 4) FROM (" + _corr_rows(_NUM, "customer") + ")"]
    ),
)
def data_profile(spark, sf):
    return eda.data_profile(table(spark, sf, "customer")).withColumn("value", rounded("value"))


@query(
    "report_context",
    " UNION ALL ".join(
        ["SELECT 'size' AS section, 'n_rows' AS item, CAST(count(*) AS VARCHAR) AS value FROM orders", "SELECT 'size', 'n_columns', '6'",
         "SELECT 'time', 'first', CAST(min(o_orderdate) AS VARCHAR) FROM orders", "SELECT 'time', 'last', CAST(max(o_orderdate) AS VARCHAR) FROM orders"]
        + [
            f"SELECT '{s}', '{i}', CAST(round({e}, 4) AS VARCHAR) FROM orders"
            for s, i, e in (
                ("range", "o_orderkey_min", "min(o_orderkey)::DOUBLE"), ("range", "o_orderkey_max", "max(o_orderkey)::DOUBLE"), ("mean", "o_orderkey", "avg(o_orderkey)"),
                ("range", "o_custkey_min", "min(o_custkey)::DOUBLE"), ("range", "o_custkey_max", "max(o_custkey)::DOUBLE"), ("mean", "o_custkey", "avg(o_custkey)"),
                ("range", "o_totalprice_min", "min(o_totalprice)"), ("range", "o_totalprice_max", "max(o_totalprice)"), ("mean", "o_totalprice", "avg(o_totalprice)"),
            )
        ]
        + [f"SELECT 'missing', '{c}', CAST(count(*) - count({c}) AS VARCHAR) FROM orders" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")]
    ),
)
def report_context(spark, sf):
    return eda.report_context(table(spark, sf, "orders"), "o_orderdate")
