"""Cleaning and data quality over tables with injected defects."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.functions.numeric import rounded
from brightloom.operators import quality
from brightloom.plans.common import null_every, table, typo
from brightloom.registry import query

# DuckDB text of the defective customer table.
_BAD = """bad AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 37 = 0 THEN concat(substr(c_mktsegment, 1, 2), 'x', substr(c_mktsegment, 4))
  ELSE c_mktsegment END AS c_mktsegment FROM customer)"""

_FIX = """cnt AS (SELECT c_mktsegment AS v, count(*) AS n FROM bad WHERE c_mktsegment IS NOT NULL GROUP BY 1),
 near AS (SELECT a.v AS old, a.n, b.v AS new, levenshtein(a.v, b.v) AS distance, row_number() OVER (PARTITION BY a.v ORDER BY b.n DESC, b.v) AS r
          FROM cnt a JOIN cnt b ON a.v <> b.v AND b.n >= 2 * a.n AND levenshtein(a.v, b.v) <= 1),
 fix AS (SELECT old, new, n, distance FROM near WHERE r = 1),
 fixed AS (SELECT c_custkey, c_nationkey, c_acctbal, coalesce(fix.new, c_mktsegment) AS c_mktsegment, c_mktsegment AS before
           FROM bad LEFT JOIN fix ON fix.old = c_mktsegment)"""


def bad_customer(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", null_every("c_custkey", "c_acctbal").alias("c_acctbal"),
        F.when(F.col("c_custkey") % 7 != 0, typo("c_custkey", "c_mktsegment")).alias("c_mktsegment"),
    )


@query("drop_null_rows", f"WITH {_BAD} SELECT * FROM bad WHERE c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL")
def drop_null_rows(spark, sf):
    return bad_customer(spark, sf).na.drop()


@query(
    "fill_constant",
    f"WITH {_BAD} SELECT c_custkey, c_nationkey, coalesce(c_acctbal, 0) AS c_acctbal, coalesce(c_mktsegment, 'unknown') AS c_mktsegment FROM bad",
)
def fill_constant(spark, sf):
    return bad_customer(spark, sf).na.fill({"c_acctbal": 0.0, "c_mktsegment": "unknown"})


@query(
    "impute_mean_mode",
    f"""WITH {_BAD} SELECT c_custkey, c_nationkey, round(coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM bad)), 4) AS c_acctbal,
        coalesce(c_mktsegment, (SELECT c_mktsegment FROM bad WHERE c_mktsegment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1))
        AS c_mktsegment FROM bad""",
)
def impute_mean_mode(spark, sf):
    out = quality.impute_mean_mode(bad_customer(spark, sf), ["c_acctbal"], ["c_mktsegment"])
    return out.withColumn("c_acctbal", rounded("c_acctbal"))


@query("typo_correction", f"WITH {_BAD}, {_FIX} SELECT c_custkey, before, c_mktsegment AS after FROM fixed")
def typo_correction(spark, sf):
    bad = bad_customer(spark, sf).select("c_custkey", F.col("c_mktsegment").alias("before"), F.col("c_mktsegment").alias("after"))
    fixed, _ = quality.typo_correction(bad, "after")
    return fixed


@query(
    "column_anomaly_report",
    """WITH s AS (SELECT unnest(['c_name', 'c_mktsegment']) AS "column", unnest([c_name, CASE WHEN c_custkey % 37 = 0 THEN
           concat(substr(c_mktsegment, 1, 2), '7', substr(c_mktsegment, 4)) ELSE c_mktsegment END]) AS v FROM customer),
        p AS (SELECT "column", 'pattern' AS "check", regexp_replace(regexp_replace(v, '[A-Za-z]+', 'A', 'g'), '[0-9]+', '9', 'g') AS item,
              count(*) AS n FROM s GROUP BY ALL),
        b AS (SELECT unnest(['c_custkey', 'c_nationkey', 'c_acctbal']) AS "column",
              unnest([c_custkey::DOUBLE, c_nationkey::DOUBLE, CASE WHEN c_custkey % 97 = 0 THEN c_acctbal * 10 ELSE c_acctbal END]) AS v FROM customer),
        q AS (SELECT "column" AS qc, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM b GROUP BY 1),
        i AS (SELECT "column", 'iqr' AS "check", CASE WHEN v < q1 - 1.5 * (q3 - q1) THEN 'low' WHEN v > q3 + 1.5 * (q3 - q1)
              THEN 'high' ELSE 'inside' END AS item, count(*) AS n FROM b JOIN q ON qc = "column" GROUP BY ALL),
        u AS (SELECT * FROM p UNION ALL SELECT * FROM i)
       SELECT *, round(n / sum(n) OVER (PARTITION BY "column"), 6) AS share,
              CASE WHEN "check" = 'pattern' THEN n / sum(n) OVER (PARTITION BY "column") < 0.05 ELSE item <> 'inside' END AS suspicious FROM u""",
)
def column_anomaly_report(spark, sf):
    s, k = F.col("c_mktsegment"), F.col("c_custkey")
    c = table(spark, sf, "customer").withColumns(
        {
            "c_mktsegment": F.when(k % 37 == 0, F.concat(F.substring(s, 1, 2), F.lit("7"), s.substr(F.lit(4), F.length(s)))).otherwise(s),
            "c_acctbal": F.when(k % 97 == 0, F.col("c_acctbal") * 10).otherwise(F.col("c_acctbal")),
        }
    )
    return quality.column_anomaly_report(c).withColumn("share", rounded("share", 6))


@query(
    "cleaning_log",
    f"""WITH {_BAD}, {_FIX} SELECT 'typo' AS step, 'c_mktsegment' AS "column", count(*) FILTER (c_mktsegment IS DISTINCT FROM before) AS n_changed
        FROM fixed UNION ALL SELECT 'impute', 'c_acctbal', count(*) FILTER (c_acctbal IS NULL) FROM bad
        UNION ALL SELECT 'impute', 'c_mktsegment', count(*) FILTER (c_mktsegment IS NULL) FROM bad""",
)
def cleaning_log(spark, sf):
    bad = bad_customer(spark, sf).withColumns({"before": F.col("c_mktsegment"), "balance": F.col("c_acctbal")})
    fixed, _ = quality.typo_correction(bad, "c_mktsegment")
    fixed = fixed.withColumn("typed", F.col("c_mktsegment"))
    clean = quality.impute_mean_mode(fixed, ["c_acctbal"], ["c_mktsegment"])
    col = F.col
    return quality.cleaning_log(
        clean,
        {
            ("typo", "c_mktsegment"): (col("before"), col("typed")),
            ("impute", "c_acctbal"): (col("balance"), col("c_acctbal")),
            ("impute", "c_mktsegment"): (col("typed"), col("c_mktsegment")),
        },
    )


@query(
    "clean_dataset",
    f"""WITH {_BAD}, {_FIX} SELECT c_custkey, c_nationkey, round(coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM fixed)), 4) AS c_acctbal,
        coalesce(c_mktsegment, (SELECT c_mktsegment FROM fixed WHERE c_mktsegment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1))
        AS c_mktsegment FROM fixed""",
)
def clean_dataset(spark, sf):
    out = quality.clean_dataset(bad_customer(spark, sf), ["c_mktsegment"], ["c_acctbal"])
    return out.withColumn("c_acctbal", rounded("c_acctbal"))


@query(
    "clean_dataset_report",
    f"""WITH {_BAD}, {_FIX}, d AS (SELECT coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM fixed)) AS v,
          coalesce(c_mktsegment, (SELECT c_mktsegment FROM fixed WHERE c_mktsegment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS s FROM fixed),
        f AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM d),
        u AS (SELECT 'c_mktsegment' AS "column", 'pattern' AS "check", regexp_replace(regexp_replace(s, '[A-Za-z]+', 'A', 'g'), '[0-9]+', '9', 'g') AS item, count(*) AS n FROM d GROUP BY 3
              UNION ALL SELECT 'c_acctbal', 'iqr', CASE WHEN v < q1 - 1.5 * (q3 - q1) THEN 'low' WHEN v > q3 + 1.5 * (q3 - q1) THEN 'high' ELSE 'inside' END, count(*) FROM d, f GROUP BY 3)
        SELECT *, round(n / sum(n) OVER (PARTITION BY "column"), 6) AS share,
               CASE WHEN "check" = 'pattern' THEN n / sum(n) OVER (PARTITION BY "column") < 0.05 ELSE item <> 'inside' END AS suspicious FROM u""",
)
def clean_dataset_report(spark, sf):
    """What is suspicious in the cleaned table: shapes of texts and values beyond the fences."""
    _, report = quality.clean_and_report(bad_customer(spark, sf), ["c_mktsegment"], ["c_acctbal"])
    return report.withColumn("share", rounded("share", 6))


def _num(c):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{m}' AS metric, NULL AS item, {e} AS value FROM e"""
        for m, e in (("mean", f"avg({c})"), ("std", f"stddev_samp({c})"), ("min", f"min({c})"), ("max", f"max({c})"))
    )


def _text(c):
    return f"""SELECT '{c}', 'unique_count', NULL, count(DISTINCT {c}) FROM e
      UNION ALL (SELECT '{c}', 'top_value', {c}, count(*) FROM e GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 5)"""


@query(
    "data_quality_metrics",
    f"""WITH e AS (SELECT * REPLACE (CASE WHEN event_id % 10 <> 0 THEN value END AS value) FROM events),
        a AS (SELECT '*' AS "column", 'row_count' AS metric, NULL AS item, CAST(count(*) AS DOUBLE) AS value FROM e
          UNION ALL SELECT '*', 'duplicate_rows', NULL, (SELECT count(*) FROM e) - (SELECT count(*) FROM (SELECT DISTINCT * FROM e))
          UNION ALL {" UNION ALL ".join(f"SELECT '{c}', 'null_count', NULL, count(*) - count({c}) FROM e" for c in ("event_id", "ts", "user_id", "event_type", "value", "props"))}
          UNION ALL {_num("event_id")} UNION ALL {_num("user_id")} UNION ALL {_num("value")} UNION ALL {" UNION ALL ".join(_text(c) for c in ("event_type", "props"))})
       SELECT "column", metric, CAST(item AS VARCHAR) AS item, round(value, 4) AS value FROM a""",
)
def data_quality_metrics(spark, sf):
    e = table(spark, sf, "events").withColumn("value", null_every("event_id", "value"))
    return quality.data_quality_metrics(e).withColumn("value", rounded("value"))


_TYPES = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


@query(
    "dataset_overview",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, '{ {"string": "categorical", "timestamp_ntz": "other"}.get(t, "numeric") }' AS kind,
            {"true" if "date" in c else "false"} AS is_temporal, count(*) - count({c}) AS n_missing, count(DISTINCT {c}) AS n_unique FROM orders"""
        for c, t in _TYPES.items()
    ),
)
def dataset_overview(spark, sf):
    return quality.dataset_overview(table(spark, sf, "orders"))


@query(
    "target_profile",
    """SELECT 'n_rows' AS item, CAST(count(*) AS VARCHAR) AS value FROM lineitem UNION ALL SELECT 'n_features', '10'
       UNION ALL SELECT 'task', CASE WHEN count(DISTINCT l_returnflag) = 2 THEN 'binary' ELSE 'multiclass' END FROM lineitem
       UNION ALL SELECT 'has_missing', 'false' UNION ALL SELECT 'has_categorical', 'true'
       UNION ALL SELECT 'class_' || l_returnflag, CAST(round(count(*) / (SELECT count(*) FROM lineitem), 6) AS VARCHAR) FROM lineitem GROUP BY l_returnflag""",
)
def target_profile(spark, sf):
    return quality.target_profile(table(spark, sf, "lineitem"), "l_returnflag")
